import os

import numpy as np
import pytest

from kbspark.llm import mixing
from kbspark.llm.mixing import fit_rates, learn_domains, memberships, mix, shares
from kbspark.llm.tokens import FOLDER, NAME

pytestmark = pytest.mark.skipif(not os.path.exists(f"{FOLDER}/{NAME}.tiktoken"), reason="no tokenizer files")


def docs(spark):
    words = {"big": "alpha beta gamma", "mid": "delta epsilon zeta", "tiny": "eta theta iota"}
    rows = []
    for s, n in (("big", 400), ("mid", 150), ("tiny", 20)):
        rows += [(len(rows) + i, f"{words[s]} " * (5 + i % 7), [s, s.upper() + " "][i % 2], "x") for i in range(n)]
    rows += [(9001, None, "big", None), (9002, "", "mid", None), (9003, "delta epsilon " * 9, None, None), (9004, "delta", "unknown", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, rate string")


def test_targets_are_reached_within_the_caps(spark):
    goal = spark.createDataFrame([(" BIG", 0.5, 1), ("mid", 0.3, 2), ("tiny", 0.2, 4)], "source string, target_share double, max_repeats int")
    mixed = mix(docs(spark), goal, spark)
    rows = {r.source: r for r in shares(mixed, goal).collect()}
    assert mixed.count() == 574
    assert all(r.reached for r in rows.values()), rows
    assert rows["tiny"].most_copies <= 4 and rows["big"].most_copies <= 1
    soft = {r.doc_id: r.domain for r in mixed.where("doc_id in (9003, 9004)").collect()}
    assert soft[9003] == "mid"


def test_unreachable_targets_are_reported(spark):
    goal = spark.createDataFrame([("big", 0.4, 1), ("tiny", 0.5, 2), ("absent", 0.1, 3), (None, 0.5, 1)], "source string, target_share double, max_repeats int")
    rows = {r.source: r for r in shares(mix(docs(spark), goal, spark, total_tokens=9000.0), goal).collect()}
    assert not rows["tiny"].reached and rows["tiny"].most_copies == 2
    assert rows["absent"].tokens == 0 and not rows["absent"].reached


def test_default_size_where_a_source_has_no_documents(spark):
    goal = spark.createDataFrame([("big", 0.4, 1), ("mid", 0.3, 2), ("tiny", 0.2, 4), ("absent", 0.1, 3)], "source string, target_share double, max_repeats int")
    mixed = mix(docs(spark), goal, spark).cache()
    assert mixed.where("doc_id in (9003, 9004) and source is null").count() == 1
    rows = {r.source: r for r in shares(mixed, goal).collect()}
    tiny = sum(r.tokens for r in mixed.where("source = 'tiny'").collect())
    # tiny at its cap of 4 sets the size of the mix
    whole = tiny * 4 / 0.2
    assert all(abs(rows[s].tokens - share * whole) <= 0.03 * whole for s, share in (("big", 0.4), ("mid", 0.3), ("tiny", 0.2))), (rows, whole)
    assert rows["absent"].tokens == 0 and not rows["absent"].reached


def test_empty_tables(spark):
    goal = spark.createDataFrame([("big", 1.0, 1)], "source string, target_share double, max_repeats int")
    assert mix(docs(spark).limit(0), goal, spark).count() == 0
    assert mix(docs(spark), goal.limit(0), spark).where("copies > 0").count() == 0


def test_every_document_has_a_posterior(spark):
    """Words and source both count; where words say nothing of the source, the classifier knows."""
    rows = docs(spark)
    model, temperature = learn_domains(rows, ["big", "mid", "tiny"])
    assert temperature > 0.05
    got = {r.doc_id: r for r in memberships(rows, spark, ["big", "mid", "tiny"], np.array([1.0, 2.0, 4.0])).collect()}
    assert all(abs(sum(r.posterior) - 1) < 1e-9 for r in got.values())
    assert got[0].posterior[0] > 0.99 and got[0].cap == 1.0 and got[9003].posterior[1] > 0.9
    plain = spark.createDataFrame([(i, f"same words {i % 7}", ["big", "mid", "mid"][i % 3]) for i in range(300)] + [(300, "same words", None)], "doc_id long, text string, source string")
    assert learn_domains(plain, ["big", "mid"])[1] <= 0.02
    p = memberships(plain, spark, ["big", "mid"], np.array([1.0, 2.0])).where("doc_id = 300").first().posterior
    assert abs(p[1] - 2 / 3) < 0.05


def test_rates_are_the_least_squares(spark, monkeypatch):
    """Soft members against the normal equations, with rates written between the steps."""
    monkeypatch.setattr(mixing, "CARRIED_AFTER", 3)
    rnd = np.random.default_rng(4)
    p = rnd.dirichlet([1, 1, 1], 60)
    t = rnd.integers(1, 50, 60)
    rows = [(i, "x", int(t[i]), [float(x) for x in p[i]], 5.0, 1.0) for i in range(60)]
    members = spark.createDataFrame(rows, "doc_id int, source string, tokens long, posterior array<double>, cap double, rate double")
    goal = np.array([900.0, 500.0, 700.0])
    fitted, got = fit_rates(mixing.cut(members, "members"), goal)
    assert np.abs(got - goal).max() < 0.01 * goal.sum()
    rates = {r.doc_id: r.rate for r in fitted.collect()}
    assert all(0 <= x <= 5 for x in rates.values())
    assert np.allclose(sum(rates[i] * t[i] * p[i] for i in range(60)), got)
    with pytest.warns(UserWarning, match="miss a target"):
        fit_rates(mixing.cut(members, "members"), goal * 100, most_steps=1)
