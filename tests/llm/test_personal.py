import random

import pytest

from kbspark.llm import personal
from kbspark.llm.personal import NAME, Names, detect, graph, label, learn_names, learnt_sample, marginals, occurrences, redacted, right_check

SUR, GIV = "王林赵高周何蔚冉", "荇绾霁鸢珞苒遥沐铎昱"
FIRST, LAST = "Torben Orla Maelis Tamsin Ludo Corvin Saskia Evander".split(), "Quenby Marwick Holmquist Ashgrove Dunsany Lindqvale Brackenridge".split()
#: Sentences to learn from, which nobody labels; {h} and {l} are names, {x} other words.
LEARN = ["联系人：{h}，电话 1500047{n}。", "姓名：{h}，已核对{x}。", "昨天由{h}确认了{x}。", "{x}组的{h}和{h}检查了{x}。", "请找{h}确认{x}。", "会后{h}补交了{x}。", "Contact: {l}, about the {x}.", "Ms. {l} asked for the {x}.", "The {x} belongs to {l}, as agreed.",
         "Ring {l} or write.", "据{l}反映，{x}正常。", "The {x} was late.", "{x}与周报一致，高出王牌。", "Annual Report and {x}. Quality Office closed.", "周一赵州桥的{x}。", "Use Dorlo Garfen for the {x}.", "何时登记{x}。", "林区的{x}。"]
#: Sentences of other wording, of which none is learnt from.
HELD_OUT = ["听说{h}明天到。", "我们在大厅遇见{h}，聊了很久。", "Yesterday {l} left for Bremen.", "We never met {l} before.", "{h}同意了这个方案。", "A letter for {l} has arrived.", "感谢{h}的帮助。", "They named {l} as the winner."]


def sentences(seed, forms, n, last=LAST):
    """(text, names in it) of sentences with names of random parts."""
    rnd, out = random.Random(seed), []
    for _ in range(n):
        form, names = rnd.choice(forms), []
        while "{h}" in form or "{l}" in form:
            han = "{h}" in form and (form.find("{h}") < form.find("{l}") or "{l}" not in form)
            name = rnd.choice(SUR) + "".join(rnd.sample(GIV, rnd.randint(1, 2))) if han else f"{rnd.choice(FIRST)} {rnd.choice(last)}"
            form = form.replace("{h}" if han else "{l}", name, 1)
            names.append(name)
        out.append((form.replace("{x}", rnd.choice(["台账", "ledger", "目录", "pallet", "终端"])).replace("{n}", f"{rnd.randrange(10000):04}"), names))
    return out


@pytest.fixture(scope="module")
def learnt():
    return learn_names([{"content": t} for t, _ in sentences(1, LEARN, 1500)])


def names_in(text, model):
    return [text[s:e] for _, k, s, e in label({"content": text}, model) if k == NAME]


def found(text, kind=None, model=Names()):
    return [text[s:e] for _, k, s, e in sorted(label({"content": text}, model), key=lambda x: x[2]) if kind in (None, k)]


def test_names_in_wording_that_was_not_learnt(learnt):
    rows = sentences(2, HELD_OUT, 400)
    got = [names_in(t, learnt) for t, _ in rows]
    right = sum(len(set(a) & set(b)) for a, (_, b) in zip(got, rows))
    assert right >= 0.95 * sum(len(b) for _, b in rows)
    assert right >= 0.95 * sum(len(a) for a in got)
    plain = [t for t, names in sentences(3, [f for f in LEARN if "{h}" not in f and "{l}" not in f], 200)]
    assert sum(len(names_in(t, learnt)) for t in plain) == 0


def test_skip_edges_find_plain_repeats(learnt, monkeypatch):
    """Where a part of a name is unknown and nothing around shows it, the mention before it does; without messages it is lost."""
    unknown = ["Zimmerfeld", "Oakenshott", "Prentiss", "Vaughan"]
    rows = [(a + " Much later, near the canal, " + names[0] + " slept.", names[0]) for a, names in sentences(4, ["Ms. {l} asked for the {x}.", "The {x} belongs to {l}, as agreed."], 100, unknown)]
    both = sum(names_in(t, learnt).count(n) == 2 for t, n in rows)
    monkeypatch.setattr(personal, "ROUNDS", 0)
    without = sum(names_in(t, learnt).count(n) == 2 for t, n in rows)
    assert both >= 0.95 * len(rows) and without <= 0.5 * len(rows)


def test_couplings_are_learnt(learnt):
    assert learnt.skip >= 1.0 and all(0 <= x <= 2.5 for x in learnt.chain.values())
    nodes, unary, edges = graph({"content": "联系人：蔚荇绾，电话 15000471794。会后蔚荇绾补交。"}, learnt)
    assert {k for _, _, k in edges} == {"over", "next", "same"} and len(nodes) == len(unary)


def test_nothing_to_learn_from():
    for docs in ([], [{}], [{"content": "plain words"}], [{"content": "Contact Orla Marwick, please"}]):
        assert label({"content": "mail a.b@example.org"}, learn_names(docs)) == [("content", "email", 5, 20)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("有疑问请写信到quilla_holmquist[at]example[dot]org，或拨打177-0095-1656。", ["quilla_holmquist[at]example[dot]org", "177-0095-1656"]),
        ("Mail A.B+x@KB-DEPT.EXAMPLE about it.", ["A.B+x@KB-DEPT.EXAMPLE"]),
        ("| １７１００７９１０００ | a-b＠mail.example.com |", ["１７１００７９１０００", "a-b＠mail.example.com"]),
        ("Call (470) 555-0156 or +44 7700 900168.", ["(470) 555-0156", "+44 7700 900168"]),
        ("现住云澜市东洛区白鹭东路719号2幢301室，3月18日起生效。", ["云澜市东洛区白鹭东路719号2幢301室"]),
        ("She lives at 773 Osterway Ave, Apt 9, Dunverley 41716. Then", ["773 Osterway Ave, Apt 9, Dunverley 41716"]),
        ("Ring Torben Quenby or write.", ["Torben Quenby"]),
        ("联系人：蔚荇绾，电话 15000471794。", ["蔚荇绾", "15000471794"]),
        ("据Torben-Maelis A. Quenby反映。", ["Torben-Maelis A. Quenby"]),
        ("条码 10588059838 有误。流水号 922684198007231514。地址段 192.0.2.219:8050 已停用。", []),
        ("请@全体成员合并。Mention @channel now. Part no. 44-14101-7.", []),
        ("联系人一栏为空，流程负责人待定。", []),
    ],
)
def test_cases(text, want, learnt):
    assert found(text, model=learnt) == want


def test_check_character():
    assert right_check("11010519491231002X")
    assert not right_check("110105194912310021")
    assert found("身份证号11010519491231002X，一致。") == ["11010519491231002X"]
    assert found("身份证号110105194912310021，一致。", "id_number") == []
    assert found("Passport or ID: 921-42-1892.", "id_number") == ["921-42-1892"]


def test_skip_edges_carry_a_name_to_a_plain_mention():
    p = marginals([3.0, -0.8], [(0, 1, 0.0, 1.6)])
    assert p[0] > 0.9 and p[1] > 0.5
    assert marginals([3.0, -0.8], [])[1] < 0.5


def test_redaction_keeps_the_rest():
    text = "😀 mail b@c.example now"
    spans = [(s, e, k) for _, k, s, e in label({"content": text}, Names())]
    assert redacted(text, spans) == "😀 mail [EMAIL] now"


def test_operator_on_dirty_rows(spark):
    rows = [(" kb-1", "写信到a.b@example.org。", None, "x"), ("KB-1", "写信到a.b@example.org。", None, "y"), ("KB-2", None, None, None), ("KB-3", "", "\n", None), (None, "c@d.example", None, None), ("KB-4", "无", "z" * 100_000 + " e@f.example", None)]
    df = spark.createDataFrame(rows, "source_id string, content string, summary string, spans string")
    got = {tuple(r) for r in occurrences(detect(df)).collect()}
    assert got == {("KB-1", "content", "email", 3, 18), ("KB-4", "summary", "email", 100_001, 100_012)}
    assert detect(df).count() == len(rows)
    assert occurrences(detect(df.limit(0))).count() == 0


def test_the_sample_is_bounded(spark):
    df = spark.createDataFrame([(f"KB-{i}", f"text {i}", None) for i in range(3000)], "source_id string, content string, summary string")
    assert 150 < len(learnt_sample(df, 200)) < 260 and len(learnt_sample(df, 5000)) == 3000


def test_every_row_is_learnt_from(spark, monkeypatch):
    """Names are learnt in pieces, and what a piece alone shows counts, in any order of the rows and any partitions."""
    monkeypatch.setattr(personal, "LEARNT_FROM", 900)
    rows = [(f"KB-{i}", t, None) for i, (t, _) in enumerate(sentences(1, LEARN, 4000))] + [(f"KB-NEW-{i}", f"联系人：赵{c}，已核对目录。", None) for i, c in enumerate("柠檬橙梨桃杏枣莓葵蔓")]
    schema = "source_id string, content string, summary string"
    model = personal.names_of(spark.createDataFrame(rows, schema))
    assert all(model.words["giv"][c] for c in "柠檬橙梨桃杏枣莓葵蔓")
    held = sentences(2, HELD_OUT, 400)
    got = [names_in(t, model) for t, _ in held]
    right = sum(len(set(a) & set(b)) for a, (_, b) in zip(got, held))
    assert right >= 0.95 * sum(len(b) for _, b in held) and right >= 0.95 * sum(len(a) for a in got)
    again = personal.names_of(spark.createDataFrame(rows[::-1], schema).repartition(3))
    assert again.words == model.words and again.weights == model.weights and again.chain == model.chain and again.skip == model.skip


def test_candidates_of_names_are_those_of_the_patterns():
    """Character tables against the forms as patterns, text by text."""
    import random
    import re
    from collections import Counter

    from kbspark.llm import personal

    h, rnd = personal._H, random.Random(3)
    for sur in (["王", "李", "欧阳"], ["王"], ["欧阳", "欧"]):
        names = personal.Names({"sur": Counter(sur), "giv": Counter("芳明阳")})
        one = "".join(w for w in sur if len(w) == 1)
        s, g, edge = f"[{one}]", "[芳明阳]", f"(?<!{h})"
        two = "|".join(w for w in sur if len(w) == 2)
        forms = [f"(?=({p}))" for p in (f"{s}{g}{h}", f"{s}{h}{g}", f"{s}{h}")] + [f"{edge}(?=({p}))" for p in (f"{h}{g}{g}", f"{h}{g}(?!{h})", f"{h}{h}{g}{g}")]
        for _ in range(300):
            t = "".join(rnd.choice("王李欧阳芳明的在 ，a1") for _ in range(rnd.randint(0, 12)))
            known = set(personal.latin_spans(t))
            for m in re.finditer(f"(?=((?:{two + '|' if two else ''}{s}){g}{{1,2}}))", t):
                a, n = m.start(), m.group(1)
                k = 2 if n[:2] in sur else 1
                known |= {(a, a + x) for x in range(k + 1, len(n) + 1)} | ({(a, a + 2)} if k == 2 and n[0] in sur and n[1] in "芳明阳" else set())
            assert set(names.spans(t)) == known, t
            assert set(names.spans(t, True)) == known | {(m.start(1), m.end(1)) for p in forms for m in re.finditer(p, t)}, t


def test_a_piece_is_searched_as_one_text(monkeypatch):
    """Once a round, however many texts it has."""
    from kbspark.llm import personal

    wide, spans = [], personal.Names.spans
    monkeypatch.setattr(personal.Names, "spans", lambda self, t, *more: wide.append(more) or spans(self, t, *more))
    docs = [{"content": f"联系人：王芳，{i}号会议由李明主持。", "summary": "Dr. Anna Berg met 王芳"} for i in range(30)]
    assert personal.learnt_from(docs) and sum(bool(m) and m[0] for m in wide) <= 4
    assert personal.learnt_from([])[("size", "")] == (1.0, 0.0)
