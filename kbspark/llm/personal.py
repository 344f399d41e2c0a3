"""Personal information in free text by a skip-chain conditional random field over candidate spans.

A node is a span that could be a case. Its own potential says what it is made of and what
stands around it: for numbers and addresses by their patterns, which TESTDATA defines, for
names by weights learnt from the corpus. Chain edges join neighbours, skip edges join
mentions of the same, and messages run until none moves.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbspark.functions.text import canonical_id

EMAIL, PHONE, ID, ADDRESS, NAME = "email", "phone", "id_number", "address", "person_name"
#: Full-width forms read as their narrow ones, place for place.
_NARROW = {i: i - 0xFEE0 for i in range(0xFF01, 0xFF5F)} | {0x3000: 0x20, 0xA0: 0x20, 0x2010: 0x2D, 0x2011: 0x2D, 0x2013: 0x2D, 0x2212: 0x2D}
_H = r"[㐀-鿿]"
_HAN = re.compile(_H)

_AT, _DOT = r"(?:@| ?[\[({<]at[\])}>] ?| at (?=[\w-]+ ?[\[({. ]))", r"(?:\.| ?[\[({<]dot[\])}>] ?| dot )"
_EMAIL = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9](?:[A-Za-z0-9_%+-]|\.(?=[A-Za-z0-9]))*{_AT}[A-Za-z0-9][A-Za-z0-9-]*(?:{_DOT}[A-Za-z0-9-]+)*{_DOT}[A-Za-z]{{2,}}(?![A-Za-z0-9])", re.I)
_PHONES = [
    (3.0, re.compile(r"(?<![\dA-Za-z.+-])(?:(?:\+|00)86[- ]?|\(\+?86\) ?)?1[3-9]\d[- ]?\d{4}[- ]?\d{4}(?![\d-]*\d)")),
    (2.5, re.compile(r"(?<![\dA-Za-z.+-])(?:(?:\+|00)86[- ]?)?(?:\(0?\d{2,3}\) ?|0\d{2,3}[- ]?)\d{4}[- ]?\d{3,4}(?:[-转]\d{1,5})?(?![\d-]*\d)")),
    (3.0, re.compile(r"(?<![\dA-Za-z.+-])(?:\+?1[-. ])?(?:\(\d{3}\) ?|\d{3}[-. ])\d{3}[-. ]\d{4}(?![\d-]*\d)")),
    (3.5, re.compile(r"(?<![\dA-Za-z.+-])(?:(?:\+|00)\d{1,3}[-. /]?)(?:\(0\) ?)?\(?\d{2,5}\)?(?:[-. /]?\d{2,5}){1,4}(?![\d-]*\d)")),
    (2.5, re.compile(r"(?<![\dA-Za-z.+-])0\d{3,4}[- /]\d{3,4}[- ]?\d{3,4}(?![\d-]*\d)")),
]
_RESIDENT = re.compile(r"(?<![\dA-Za-z-])\d{6}([- ]?)(?:18|19|20)\d{6}\1\d{3}[\dXx](?![\dA-Za-z])")
_OTHER_IDS = [re.compile(p) for p in (r"(?<![\dA-Za-z-])\d{3}-\d{2}-\d{4}(?![\d-]*\d)", r"(?<![\dA-Za-z-])[A-Z]{1,2}\d{7,8}(?![\dA-Za-z])", r"(?<![\dA-Za-z-])\d{2} \d{3} \d{3} \d{3}(?!\d)")]
#: Where numbers of seven and more characters stand.
_ZONE = re.compile(r"\d[-\d. /()]{5,}\d")
_ID_CUE = re.compile(r"(?:证件|护照|身份证|纳税|税号|税务识别|通行证|passport|\bID\b|tax|\bSSN\b|identity|Ausweis|Steuer)[^\d。.!?\n]{0,14}$", re.I)
_NUMBER_CUE = re.compile(r"(?:电话|手机|联系|拨打|回拨|致电|微信|座机|传真|\bcall\b|\bring\b|\btel\b|phone|mobile|contact|\bon\b|whatsapp|Telefon|Rufnummer|\| )[^\d。!?\n]{0,14}$", re.I)
_NO_CASE = re.compile(r"(?:条码|流水号?|序列号?|编号|单号|订单号?|工单|批次号?|版本号?|型号|地址段|端口|料号|serial|order|batch|version|ticket|barcode|invoice|\bsku\b|\bref\b|\bIP\b|\blot\b|Nummer)[^\d。!?\n]{0,6}[A-Z]{0,4}$", re.I)

_UNIT = r"(?:\d{1,4}|[A-Za-z])(?:号楼|幢|栋|座|单元|楼|层|室|号|户)|\d{3,4}(?!\d|[^\d\s,，。；;]{0,3}[元份项页])"
_ROAD = re.compile(rf"{_H}{{1,12}}?(?:大道|支路|路|街|巷|弄|胡同)(?:东|西|南|北|中)?(?:段)?\d{{1,5}}(?:-\d+)?号(?:{_UNIT})*")
_HAN_ROAD, _UNITS = re.compile(r"(?:大道|路|街|巷|弄|胡同)(?:东|西|南|北|中)?(?:段)?\d{1,5}(?:-\d+)?号"), re.compile(rf"(?:{_UNIT})*")
_CITY = re.compile(rf"^(.*?)({_H}{{2,4}}?(?:市|县))?({_H}{{2,3}}?(?:新区|区|镇|乡))?({_H}{{1,8}}?)$")
_EN_ROAD = re.compile(
    r"(?<![\w-])\d{1,5}[A-Za-z]? (?:[A-Z][a-z]+ ){1,3}(?:Street|Road|Avenue|Lane|Close|Drive|Way|Court|Place|Square|Terrace|Crescent|Boulevard|Row|Hill|Gardens|(?:St|Rd|Ave|Ln|Dr|Blvd|Ct|Pl|Sq)\b\.?)"
    r"(?:, (?:Apt|Flat|Unit|Suite|Apartment|Floor|Room)\.? ?#?[0-9A-Za-z]{1,5})?(?:, [A-Z][a-z]+(?: [A-Z][a-z]+)?(?=[ ,.;:!?\n|)]|$)(?: [A-Z]{2})?(?:,? \d{5}(?!\d))?)?"
)
_DE_ROAD = re.compile(r"(?<![\w-])[A-ZÄÖÜ][a-zäöüß-]*(?:straße|strasse|str\.|weg|gasse|platz|allee|ring|ufer) \d{1,4} ?[a-z]?(?:, (?:\d\. Stock|Whg\.? \d+))?(?:, \d{5} [A-ZÄÖÜ][a-zäöüß]+)?")
#: Words that stand before an address and don't belong to it.
_TO = re.compile(r"(?:送到|送至|寄到|寄至|寄往|寄送地址|收货地址|地址|住址|现住|家住|住在|居住在|住|位于|登记|搬到|搬至|迁至|前往|到|在|至|往|从|由|为|是|于|的|和|与)[:：\s]*$")

#: Labels and forms of address beside which names stand in these languages, whatever the text is about.
_LABEL = r"(?:联系人|收件人|签收人|负责人|申请人|经办人?|姓名|发件人|抄送人?)"
_SEED_HAN = re.compile(rf"{_LABEL}(?:[:：]\s?|\s)({_H}{{2,4}})(?=[，,。；;、|｜（(\s]|$)")
_WORD = r"[A-ZÀ-ÖØ-Þ][a-zà-öø-ÿ]+(?:-[A-ZÀ-ÖØ-Þ][a-zà-öø-ÿ]+)?"
#: Two capitalised words, with an initial between them or not, at every place where they begin.
_TWO = re.compile(rf"(?<![A-Za-z0-9_.-])(?=({_WORD}(?: [A-Z]\.)? {_WORD})(?![A-Za-z0-9_-]))")
_SEED_LATIN = re.compile(rf"(?:\b(?:Mr|Mrs|Ms|Dr|Prof)\.|\b(?:Herr|Frau)|\b(?:Name|Contact|Attendees|Signed|From|To|Cc)[:,]|{_LABEL}[:：]?)\s?({_WORD}(?: [A-Z]\.)? {_WORD})(?![A-Za-z0-9_-])")

#: Log-potentials of numbers, and of two cases in one place.
NUMBER_CUE, SERIAL, BOTH = 1.0, -8.0, -12.0
#: Rounds of messages at most (they end when none moves by more than CLOSE), how much of an old message stays, how near neighbours are.
ROUNDS, CLOSE, DAMPING, NEAR = 50, 1e-3, 0.5, 40
#: How much a part of a name counts as an example of what is none.
CUT_OUT = 0.01
#: Rows of a piece of the corpus from which the potentials of names are learnt at once, at most about.
LEARNT_FROM = 12_000


def right_check(number: str) -> bool:
    """Whether an 18-character resident number ends in its check character (GB 11643) and holds a date."""
    d = re.sub(r"[- ]", "", number).upper()
    if not (1 <= int(d[10:12]) <= 12 and 1 <= int(d[12:14]) <= 31):
        return False
    return "10X98765432"[sum(int(c) * (2 ** (17 - i) % 11) for i, c in enumerate(d[:17])) % 11] == d[17]


_TABLE = np.arange(0x110000, dtype=np.uint32)
_TABLE[list(_NARROW)] = list(_NARROW.values())


def narrow(text: str) -> str:
    return _TABLE[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)].tobytes().decode("utf-32-le", "surrogatepass")


# ---------------------------------------------------------------- what names look like, learnt from the corpus


#: What a character can be in a name: Han, all of a surname, one of a given name, the first or a further one of a name.
_IS_HAN, _IS_SUR, _IS_GIV, _BEGINS, _GOES_ON = 1, 2, 4, 8, 16


def codes(t: str) -> np.ndarray:
    return np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def latin_spans(t: str) -> list[tuple[int, int]]:
    """Every two capitalised words."""
    return [(m.start(1), m.end(1)) for m in _TWO.finditer(t)]


class Names:
    """Potentials of names: weights of what a candidate is made of and what stands around it.

    ``words`` has for each part of a name (sur, giv: characters; first, last: words) how often
    it was seen; ``weights`` the log-potential of each feature; ``chain`` and ``skip`` those of
    equal labels of neighbours (by types) and of repeated mentions.
    """

    def __init__(self, words: dict[str, Counter] | None = None, weights: dict[str, float] | None = None, chain: dict[tuple[str, str], float] | None = None, skip: float = 0.0):
        self.words = {k: (words or {}).get(k, Counter()) for k in ("sur", "giv", "first", "last")}
        self.weights, self.chain, self.skip = weights or {}, chain or {}, skip
        one = {k: "".join(map(re.escape, sorted(w for w in self.words[k] if len(w) == 1))) for k in ("sur", "giv")}
        two = "|".join(sorted(w for w in self.words["sur"] if len(w) == 2))
        self.han = re.compile(rf"(?=((?:{two + '|' if two else ''}[{one['sur']}])[{one['giv']}]{{1,2}}))") if one["sur"] and one["giv"] else None
        self.kinds = np.zeros(0x110000 if self.han else 0, dtype=np.uint8)
        if self.han:
            self.kinds[0x3400:0xA000] = _IS_HAN
            pairs = [w for w in self.words["sur"] if len(w) == 2]
            for kind, chars in ((_IS_SUR | _BEGINS, [w for w in self.words["sur"] if len(w) == 1]), (_IS_GIV | _GOES_ON, [w for w in self.words["giv"] if len(w) == 1]), (_BEGINS, [w[0] for w in pairs]), (_GOES_ON, [w[1] for w in pairs])):
                for c in chars:
                    self.kinds[ord(c)] |= kind

    def spans(self, t: str, wide: bool = False, latin: list[tuple[int, int]] | None = None) -> list[tuple[int, int]]:
        """Every place that has the form of a name: two capitalised words (``latin``, where they are known), or a known surname's character before those of given names; ``wide``: also with one part unknown."""
        out = latin_spans(t) if latin is None else list(latin)
        if not self.han or not t:
            return out
        n = len(t)
        kinds = np.zeros(n + 5, dtype=np.uint8)
        kinds[1 : n + 1] = self.kinds[codes(t)]
        before, own, second, third, fourth = (kinds[k : n + k] for k in range(5))
        for a in ((own & _BEGINS > 0) & (second & _GOES_ON > 0)).nonzero()[0].tolist():
            m = self.han.match(t, a)
            if m:
                name = m.group(1)
                sur = 2 if name[:2] in self.words["sur"] else 1
                out += [(a, a + k) for k in range(sur + 1, len(name) + 1)]
                if sur == 2 and name[0] in self.words["sur"] and name[1] in self.words["giv"]:
                    out.append((a, a + 2))
        if wide:
            # one part of a name may be new; a new surname only where no other character runs into it
            new = (before & _IS_HAN == 0) & (own & _IS_HAN > 0)
            sur, giv = own & _IS_SUR > 0, second & _IS_GIV > 0
            some = [sur & giv & (third & _IS_HAN > 0), sur & (second & _IS_HAN > 0) & (third & _IS_GIV > 0), sur & (second & _IS_HAN > 0)]
            some += [new & giv & (third & _IS_GIV > 0), new & giv & (third & _IS_HAN == 0), new & (second & _IS_HAN > 0) & (third & _IS_GIV > 0) & (fourth & _IS_GIV > 0)]
            out += [(a, a + k) for at, k in zip(some, (3, 3, 2, 3, 2, 4)) for a in at.nonzero()[0].tolist()]
        return out

    def parts(self, n: str) -> list[tuple[str, str]]:
        """(kind, word) of the parts of a name."""
        if n[0].isascii() or " " in n:
            w = n.split(" ")
            return [("first", x) for x in w[0].split("-")] + [("last", w[-1])]
        sur = 2 if len(n) > 2 and (n[:2] in self.words["sur"] or len(n) == 4) else 1
        return [("sur", n[:sur])] + [("giv", c) for c in n[sur:]]

    def inside(self, n: str) -> list[str]:
        return [f"{k}:{w}" if self.words[k][w] > 1 else f"{k}?" for k, w in self.parts(n)] + [f"long{len(n)}" if not n[0].isascii() else "latin"]

    def score(self, features: list[str]) -> float:
        return self.weights.get("", 0.0) + sum(self.weights.get(f, 0.0) for f in features)


_BEFORE, _AFTER = re.compile(r"[A-Za-z]+(?=[^A-Za-z]*$)"), re.compile(r"[^A-Za-z]{0,3}([A-Za-z]+)")


def around(t: str, a: int, e: int) -> list[str]:
    """Features of what stands before and after a candidate: the nearest characters, and in Latin script words; digits are alike."""
    left, right = re.sub(r"\d", "0", t[max(0, a - 12) : a]), re.sub(r"\d", "0", t[e : e + 12])
    out = [f"<{left[-k:]}" if len(left) >= k else "<^" for k in (1, 2, 3)] + [f">{right[:k]}" if len(right) >= k else ">$" for k in (1, 2, 3)]
    if t[a].isascii():
        b, f = _BEFORE.search(left), _AFTER.match(right)
        out += [f"<<{b.group() if b else ''}", f">>{f.group(1) if f else ''}"]
    return out


def _logistic(features: list[list[str]], labels: np.ndarray, share: np.ndarray | None = None, rounds: int = 120, weight: float = 2e-4) -> dict[str, float]:
    """Weights of a regularised logistic regression by adaptive gradient steps; ``share`` is how much each case counts."""
    names = sorted({f for own in features for f in own} | {""})
    place = {f: i for i, f in enumerate(names)}
    sizes = np.array([len(f) + 1 for f in features])
    row, col = np.repeat(np.arange(len(features)), sizes), np.array([place[f] for own in features for f in ("", *own)])
    w, seen = np.zeros(len(names)), np.full(len(names), 1e-8)
    # both classes weigh the same
    one = np.ones(len(labels)) if share is None else share
    share = one * np.where(labels == 1, 0.5 / max(1.0, one @ labels), 0.5 / max(1.0, one @ (1 - labels)))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights=w[col], minlength=len(features)), -30, 30)))
        g = np.bincount(col, weights=((p - labels) * share)[row], minlength=len(names)) + weight * w / len(names) ** 0.5
        seen += g * g
        w -= 0.5 * g / np.sqrt(seen)
    return dict(zip(names, w.tolist()))


#: What a piece of the corpus says of names: by kind and key how often it was seen, and for weights also their sum.
Learnt = dict[tuple[str, str], tuple[float, float]]


def learn_names(docs: list[dict[str, str]]) -> Names:
    """Potentials of names from the texts of one piece."""
    return put_together(learnt_from(docs))


def learnt_from(docs: list[dict[str, str]]) -> Learnt:
    """What the texts of one piece, of which nothing is labelled, say of names.

    Labels and forms of address give first names; from then on what names are made of and
    what stands around them teach each other: candidates made of known parts show in what
    surroundings names stand, and these show further parts. At last the weights of both
    are fitted together to the candidates on which both agree, and the couplings to how often
    neighbours and repeated mentions among them are alike.
    """
    texts = [[narrow(t) for t in d.values()] for d in docs]
    flat = [t for own in texts for t in own]
    # all texts as one, between them what no name holds or touches
    joined = "\n".join(flat)
    starts = np.cumsum([0, *[len(t) + 1 for t in flat]])[:-1]
    latin = latin_spans(joined)
    often = np.bincount(codes(joined))
    every = Counter({chr(c): int(often[c]) for c in often.nonzero()[0]})
    every["\n"] -= max(0, len(flat) - 1)
    size = max(1, sum(every.values()))
    counts: Learnt = {("size", ""): (float(size), 0.0)} | {("every", c): (float(n), 0.0) for c, n in every.items() if _HAN.match(c)}
    seeds = {(i, m.start(1), m.end(1)) for i, t in enumerate(flat) for p in (_SEED_HAN, _SEED_LATIN) for m in p.finditer(t)}
    model = Names()
    seen: dict[tuple[int, int, int], list[str]] = {}

    def placed(wide: bool) -> list[tuple[int, int, int]]:
        """(text, start, end) of the candidates in order, each once."""
        rows = sorted(set(model.spans(joined, wide, latin)))
        which = np.searchsorted(starts, [a for a, _ in rows], side="right") - 1
        return [(i, a - s, e - s) for (a, e), i, s in zip(rows, which.tolist(), starts[which].tolist())]

    found = seeds
    spans: list[tuple[int, int, int]] = []
    labels = apart = np.empty(0)
    for _ in range(4):
        words: dict[str, Counter] = {k: Counter() for k in ("sur", "giv", "first", "last")}
        for n in {flat[i][a:e] for i, a, e in found}:
            for k, w in model.parts(n):
                words[k][w] += 1
        # a character is part of names where it stands in them far more often than elsewhere
        total = {k: max(1, sum(c.values())) for k, c in words.items()}
        odds = {(k, w): math.log((c / total[k]) / (max(1, every[w[-1]]) / size)) if k in ("sur", "giv") else 3.0 for k, own in words.items() for w, c in own.items()}
        # what labels don't show must be met twice
        shown = {p for i, a, e in seeds for p in model.parts(flat[i][a:e])}
        model = Names({k: Counter({w: c for w, c in own.items() if odds[k, w] > 0.5 and (c > 1 or (k, w) in shown)}) for k, own in words.items()})
        spans = placed(True)
        if not spans:
            return counts | _words(model)
        for i, a, e in spans:
            if (i, a, e) not in seen:
                seen[i, a, e] = around(flat[i], a, e)
        contexts = [seen[x] for x in spans]
        parts = [model.parts(flat[i][a:e]) for i, a, e in spans]
        made = np.array([sum(odds.get(p, -3.0) for p in own) / len(own) for own in parts])
        known = np.array([min(model.words[k][w] for k, w in own) for own in parts])
        whole = known > 0
        best = _longest(spans, np.where(whole, made + np.array([e - a for _, a, e in spans]) * 0.5, -9.0))
        good, bad = (made > 1.5) & whole & best, whole & ((made < 0) | ~best)
        sure = good | bad
        if not good.any() or not bad.any():
            break
        by_place = Names(weights=_logistic([c for c, ok in zip(contexts, sure) if ok], good[sure].astype(float)))
        place = np.array([by_place.score(c) for c in contexts])
        seeded = np.array([s in seeds for s in spans])
        best = _longest(spans, 2 * place + made + 9.0 * seeded)
        labels = np.where(seeded | best & ((whole & (made > 1.5) & (place > 0)) | ((place > 3) & (made > 0))), 1.0, np.where(~best | (place < -1) | (made < 0), 0.0, -1.0))
        # what is cut out of a name looks like one: it shows where names end, but hardly what isn't one
        apart = np.where(best | (made < 0), 1.0, CUT_OUT)
        found = {s for s, y in zip(spans, labels) if y == 1}
    if not (labels == 1).any() or not (labels == 0).any():
        return counts | _words(model)
    # from here on with all parts known, as candidates are
    narrow_spans = set(placed(False))
    sure = (labels >= 0) & np.array([x in narrow_spans for x in spans])
    features = [c + model.inside(flat[i][a:e]) for c, (i, a, e), ok in zip(contexts, spans, sure) if ok]
    weights, times = _logistic(features, labels[sure], apart[sure]), Counter(f for own in features for f in ("", *own))
    model = Names(model.words, weights)
    counts |= _words(model) | {("weight", f): (float(times[f]), times[f] * w) for f, w in weights.items()}
    return counts | {("link", key): (float(n), 0.0) for key, n in linked(docs, model).items()}


def _words(model: Names) -> Learnt:
    return {(k, w): (float(c), 0.0) for k, own in model.words.items() for w, c in own.items()}


def put_together(learnt: Learnt) -> Names:
    """Potentials of names from the sums of what all pieces say.

    A character is a part of names if it is by the counts of the whole corpus; a feature
    weighs what it does in the pieces, each as much as it was seen there; couplings come from
    the links of all pieces.
    """
    words: dict[str, Counter] = {k: Counter() for k in ("sur", "giv", "first", "last")}
    for (k, w), (n, _) in learnt.items():
        if k in words:
            words[k][w] = int(n)
    size = learnt.get(("size", ""), (1.0, 0.0))[0]
    for k in ("sur", "giv"):
        total = max(1, sum(words[k].values()))
        words[k] = Counter({w: c for w, c in words[k].items() if math.log((c / total) / (max(1.0, learnt.get(("every", w[-1]), (0.0, 0.0))[0]) / size)) > 0.5})
    weights = {f: v / n for (k, f), (n, v) in learnt.items() if k == "weight"}
    if weights:
        # a part that no piece saw twice has no weight of its own
        words = {k: Counter({w: c if f"{k}:{w}" in weights else 1 for w, c in own.items()}) for k, own in words.items()}
    model = Names(words, weights)
    if weights:
        model.chain, model.skip = couplings({f: n for (k, f), (n, _) in learnt.items() if k == "link"})
    return model




def _longest(spans: list[tuple[int, int, int]], score: np.ndarray) -> np.ndarray:
    """Which spans no better one overlaps; spans are in order."""
    keep = np.ones(len(spans), dtype=bool)
    for k in range(len(spans)):
        i, a, e = spans[k]
        j = k + 1
        while j < len(spans) and spans[j][0] == i and spans[j][1] < e:
            if score[j] > score[k]:
                keep[k] = False
            else:
                keep[j] = False
            j += 1
    return keep


def linked(docs: list[dict[str, str]], model: Names) -> Counter:
    """How often linked nodes whose own potential is clear are cases or not, by the kind of link or the types, and both labels."""
    seen: Counter = Counter()
    for d in docs:
        nodes, unary, edges = graph(d, model)
        for i, j, kind in edges:
            if kind != OVER and abs(unary[i]) > 2 and abs(unary[j]) > 2:
                key = SAME if kind == SAME else f"{nodes[i][3]} {nodes[j][3]}"
                seen[f"{key}/{int(unary[i] > 0)}{int(unary[j] > 0)}"] += 1
    return seen


def couplings(seen: dict[str, float]) -> tuple[dict[tuple[str, str], float], float]:
    """(chain by types, skip): half the log-odds ratio of equal labels of linked nodes, from the counts of ``linked``."""
    tables: dict[str, np.ndarray] = defaultdict(lambda: np.ones((2, 2)))
    for key, n in seen.items():
        link, _, labels = key.partition("/")
        tables[link][int(labels[0]), int(labels[1])] += n
    weigh = {k: float(np.clip(0.5 * math.log(n[0, 0] * n[1, 1] / (n[0, 1] * n[1, 0])), 0.0, 2.5)) for k, n in tables.items()}
    return {tuple(k.split(" ")): v for k, v in weigh.items() if k != SAME}, max(1.0, weigh.get(SAME, 0.0))


# ---------------------------------------------------------------- candidates and their potentials


def _number_score(t: str, start: int) -> float:
    ahead = t[max(0, start - 24) : start]
    if _NO_CASE.search(ahead):
        return SERIAL
    return NUMBER_CUE if _NUMBER_CUE.search(ahead) else 0.0


def _address_start(t: str, start: int, end: int) -> int:
    """Where the first place name of a Chinese address begins that ends in a road between ``start`` and ``end``."""
    road = t[start:end]
    m = _CITY.match(road)
    cue = max((c.end() for c in re.finditer(r"送到|送至|寄到|寄至|寄往|住址|地址|现住|家住|住在|位于|登记|搬到|迁至|前往", road)), default=None)
    if cue is not None:
        return start + cue
    if _TO.search(t, max(0, start - 8), start) or start == 0 or not re.match(_H, t[start - 1]):
        return start
    # no edge on the left: shortest names of city, district and road
    city = re.search(rf"{_H}{{2}}(?:市|县)", road)
    if city:
        return start + city.start()
    district = re.search(rf"{_H}{{2}}(?:新区|区)", road)
    if district:
        return start + district.start()
    return start + max(0, len(road) - 4) if m else start


def candidates(t: str, names: Names) -> list[tuple[int, int, str, float]]:
    """(start, end, type, log-potential of being a case) of every span that could be one; ``t`` is narrow."""
    out: dict[tuple[int, int, str], float] = {}
    if "@" in t or " at " in t or re.search(r"[\[({<]at[\])}>]", t, re.I):
        for m in _EMAIL.finditer(t):
            out[m.start(), m.end(), EMAIL] = 5.0 if "@" in m.group() or re.search(r"[\[({<]at", m.group(), re.I) else -1.0
    for zone in _ZONE.finditer(t):
        # what begins and ends near enough to see all that belongs to a number
        near = max(0, zone.start() - 6), min(len(t), zone.end() + 20)
        for m in _RESIDENT.finditer(t, *near):
            if right_check(m.group()):
                out[m.start(), m.end(), ID] = 5.0 + min(0.0, _number_score(t, m.start()))
        for p in _OTHER_IDS:
            for m in p.finditer(t, *near):
                ahead = t[max(0, m.start() - 24) : m.start()]
                out[m.start(), m.end(), ID] = (-1.5 if not _ID_CUE.search(ahead) else 4.0) + (SERIAL if _NO_CASE.search(ahead) and not _ID_CUE.search(ahead) else 0.0)
        for base, p in _PHONES:
            for m in p.finditer(t, *near):
                key = (m.start(), m.end(), PHONE)
                out[key] = max(out.get(key, -99.0), base + 0.02 * (m.end() - m.start()) + _number_score(t, m.start()) - (6.0 if _ID_CUE.search(t, max(0, m.start() - 20), m.start()) else 0.0))
    if "号" in t:
        for m in _HAN_ROAD.finditer(t):
            left = m.start()
            while left > max(0, m.start() - 24) and "㐀" <= t[left - 1] <= "鿿":
                left -= 1
            end = _UNITS.match(t, m.end()).end()
            begin = _address_start(t, left, m.start())
            if begin < m.start():
                out[begin, end, ADDRESS] = 4.5
    for p in (_EN_ROAD, _DE_ROAD):
        for m in p.finditer(t):
            out[m.start(), m.end(), ADDRESS] = 4.5
    for a, e in names.spans(t):
        out[a, e, NAME] = names.score(names.inside(t[a:e]) + around(t, a, e))
    return sorted((s, e, k, v) for (s, e, k), v in out.items())


# ---------------------------------------------------------------- the field


#: Kinds of edges: two candidates for one place, neighbours, mentions with the same wording.
OVER, NEXT, SAME = "over", "next", "same"


def graph(fields: dict[str, str], names: Names) -> tuple[list[tuple[str, int, int, str, str]], list[float], list[tuple[int, int, str]]]:
    """(nodes, their own potentials, edges) of the fields of one document.

    A node is a candidate (field, start, end, type, text). Edges: between all that overlap;
    from each to those at the next place after it, if near; and skip edges from each mention to the one
    before it with the same wording, the same last name or, in Han, the same given name.
    """
    nodes: list[tuple[str, int, int, str, str]] = []
    unary: list[float] = []
    for f, text in fields.items():
        t = narrow(text)
        for s, e, k, v in candidates(t, names):
            nodes.append((f, s, e, k, t[s:e]))
            unary.append(v)
    edges: list[tuple[int, int, str]] = []
    for i, (f, _, e, _, _) in enumerate(nodes):
        after = -1
        for j in range(i + 1, len(nodes)):
            g, s2, _, _, _ = nodes[j]
            if g != f or s2 > e + NEAR or 0 <= after < s2:
                break
            if s2 >= e:
                after = s2
            edges.append((i, j, NEXT if s2 >= e else OVER))
    seen: dict[tuple[str, str], int] = {}
    for i, (_, _, _, k, w) in enumerate(nodes):
        keys = {(k, w)}
        if k == NAME:
            keys.add((k, w.split(" ")[-1] if " " in w else w[1:] if len(w) > 2 else w))
        for before in {seen[key] for key in keys if key in seen}:
            if nodes[before][:2] != nodes[i][:2]:
                edges.append((before, i, SAME))
        for key in keys:
            seen[key] = i
    return nodes, unary, edges


def marginals(unary: list[float], edges: list[tuple[int, int, float, float]]) -> list[float]:
    """P(case) of each node by loopy message passing until no message moves; an edge weighs (both cases, equal labels)."""
    n = len(unary)
    near: list[list[int]] = [[] for _ in range(n)]
    for k, (a, b, _, _) in enumerate(edges):
        near[a].append(2 * k)  # message 2k goes from b to a, 2k + 1 from a to b
        near[b].append(2 * k + 1)
    message = [0.0] * (2 * len(edges))
    for _ in range(ROUNDS if edges else 0):
        belief = [u + sum(message[i] for i in near[v]) for v, u in enumerate(unary)]
        moved = 0.0
        for k, (a, b, both, equal) in enumerate(edges):
            for i, (source, back) in enumerate(((b, 2 * k + 1), (a, 2 * k))):
                x = max(-30.0, min(30.0, belief[source] - message[back]))
                e = math.exp(x)
                step = (1 - DAMPING) * (math.log((1 + e * math.exp(both + equal)) / (math.exp(equal) + e)) - message[2 * k + i])
                message[2 * k + i] += step
                moved = max(moved, abs(step))
        if moved < CLOSE:
            break
    return [1 / (1 + math.exp(-max(-30.0, min(30.0, u + sum(message[i] for i in near[v]))))) for v, u in enumerate(unary)]


def label(fields: dict[str, str], names: Names) -> list[tuple[str, str, int, int]]:
    """(field, type, start, end) of the cases in the fields of one document, by one field of potentials over all of them."""
    nodes, unary, links = graph(fields, names)
    edges = [(i, j, BOTH, 0.0) if k == OVER else (i, j, 0.0, names.skip if k == SAME else names.chain.get((nodes[i][3], nodes[j][3]), 0.0)) for i, j, k in links]
    p = marginals(unary, edges)
    out: list[tuple[str, str, int, int]] = []
    taken: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for i in sorted((i for i in range(len(nodes)) if p[i] > 0.5), key=lambda i: (-p[i], nodes[i][1] - nodes[i][2])):
        f, s, e, k, _ = nodes[i]
        if all(e <= a or b <= s for a, b in taken[f]):
            taken[f].append((s, e))
            out.append((f, k, s, e))
    return sorted(out)


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with a typed placeholder in the place of each span, else unchanged."""
    out, last = [], 0
    for s, e, k in sorted(spans):
        out += [text[last:s], f"[{k.upper()}]"]
        last = e
    return "".join(out) + text[last:]


FIELDS = ("content", "summary")
_SPAN = "array<struct<field_name string, pii_type string, start_pos bigint, end_pos bigint>>"


def learnt_sample(rows: DataFrame, most: int = LEARNT_FROM) -> list[dict[str, str]]:
    """The fields of at most about ``most`` rows, chosen by a hash of their text, the same ones each time; to look at, nothing is learnt from it alone."""
    key = F.pmod(F.xxhash64(*FIELDS), F.lit(1 << 30))
    n = max(1, rows.count())
    few = rows.where(key < int((1 << 30) * min(1.0, most / n))).select(*FIELDS).collect()
    return [{f: r[f] for f in FIELDS if r[f]} for r in few]


def names_of(rows: DataFrame) -> Names:
    """Potentials of names learnt from every text of ``rows``.

    The rows fall into pieces of at most about LEARNT_FROM by a hash, the same ones whatever
    the partitions; each piece is learnt from by one task, and what pieces say is added up. A
    text counts once for each id that has it: copies are spread, and a row that is given twice
    is sent once from every task.
    """
    columns = ("source_id", *FIELDS)
    key = F.xxhash64(*columns)
    pieces = max(1, -(-rows.count() // LEARNT_FROM))

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys = batch.column("key").to_pylist()
            new = [i for i, k in enumerate(keys) if not (k in seen or seen.add(k))]
            yield batch.take(pa.array(new, pa.int64()))

    def learn(piece: pa.Table) -> pa.Table:
        own = {tuple(t or "" for t in x) for x in zip(*(piece.column(f).to_pylist() for f in columns))}
        docs = [{f: t for f, t in zip(FIELDS, x[1:]) if t} for x in sorted(own)]
        found = learnt_from(docs)
        kinds, keys = zip(*found) if found else ((), ())
        n, v = zip(*found.values()) if found else ((), ())
        # weights of equal sums whatever the order in which they are added
        return pa.table({"kind": pa.array(kinds, pa.string()), "name": pa.array(keys, pa.string()), "n": pa.array(n, pa.float64()), "v": pa.array([round(x * 1e6) for x in v], pa.int64())})

    texts = rows.select(*columns, key.alias("key")).mapInArrow(once, "source_id string, content string, summary string, key bigint")
    learnt = texts.groupBy(F.pmod("key", F.lit(pieces)).alias("piece")).applyInArrow(learn, "kind string, name string, n double, v bigint")
    sums = learnt.groupBy("kind", "name").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    return put_together({(r["kind"], r["name"]): (r["n"], r["v"] / 1e6) for r in sorted(sums)})


def detect(texts: DataFrame) -> DataFrame:
    """(source_id, content, summary, spans, redacted_content, redacted_summary) of every row.

    The content and the summary of a row are one document: a name that is plain in one is
    found in the other. Null fields stay null; rows and ids given twice are kept; rows
    without id stay, with a null id. Other columns are ignored. The potentials of names are
    learnt from all rows first.
    """
    rows = texts.select(canonical_id("source_id").alias("source_id"), *[F.col(c).cast("string").alias(c) for c in FIELDS])
    shared = texts.sparkSession.sparkContext.broadcast(names_of(rows))
    span = pa.list_(pa.struct([("field_name", pa.string()), ("pii_type", pa.string()), ("start_pos", pa.int64()), ("end_pos", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = shared.value
        for batch in batches:
            for b in range(0, batch.num_rows, 500):
                part = batch.slice(b, 500)
                spans, done = [], [[], []]
                for own in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    found = label({f: t for f, t in zip(FIELDS, own) if t}, names)
                    spans.append([{"field_name": f, "pii_type": k, "start_pos": s, "end_pos": e} for f, k, s, e in found])
                    for i, (f, t) in enumerate(zip(FIELDS, own)):
                        done[i].append(t if t is None else redacted(t, [(s, e, k) for g, k, s, e in found if g == f]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(spans, span), *[pa.array(d, pa.string()) for d in done]], names=["source_id", *FIELDS, "spans", "redacted_content", "redacted_summary"])

    return rows.mapInArrow(run, f"source_id string, content string, summary string, spans {_SPAN}, redacted_content string, redacted_summary string")


def occurrences(detected: DataFrame) -> DataFrame:
    """(source_id, field_name, pii_type, start_pos, end_pos), distinct, of the rows with an id."""
    return detected.where(F.col("source_id").isNotNull()).select("source_id", F.explode("spans").alias("s")).select("source_id", "s.*").distinct()
