from __future__ import annotations

import numpy as np
import pytest

from sedimenta.llm import op3_neighbours, op4_mixing
from sedimenta.llm.queries import QUERIES

from .cases import clashing, frame, odd_rows

SF = "/root/testdata/sf0.01"
CELLS = "source string, lang string, topic string, tokens long"


def rake(cells, targets, rounds=500):
    weight = {k: float(v) for k, v in cells.items()}
    for _ in range(rounds):
        for place, target in enumerate(targets):
            sums = {}
            for k, w in weight.items():
                sums[k[place]] = sums.get(k[place], 0) + w
            weight = {k: w * target.get(k[place], 0) / sums[k[place]] if sums[k[place]] else 0.0 for k, w in weight.items()}
    return weight


def test_raking_equals_the_plain_version(spark):
    rng = np.random.default_rng(4)
    cells = {(s, g, t): int(rng.integers(0, 900)) for s in "abc" for g in "xy" for t in "pq"}
    total = sum(cells.values())
    targets = []
    for place, margin in enumerate(op4_mixing.MARGINS):
        sums = {}
        for k, v in cells.items():
            sums[k[place]] = sums.get(k[place], 0) + v
        powers = {k: v ** op4_mixing.TEMPERATURES[margin] for k, v in sums.items()}
        targets.append({k: v * total / sum(powers.values()) for k, v in powers.items()})
    want = rake(cells, targets)
    got = op4_mixing.cell_weights(spark.createDataFrame([(*k, v) for k, v in cells.items()], CELLS))
    for r in got.collect():
        assert r.weight == pytest.approx(want[r.source, r.lang, r.topic], rel=1e-4, abs=1e-3)
    c = op4_mixing.factor_for(got, 0.5)
    assert sum(min(r.tokens, c * r.weight) for r in got.collect()) == pytest.approx(0.5 * total, rel=1e-4)


def test_given_targets(spark):
    cells = spark.createDataFrame([("a", "x", "p", 100), ("b", "x", "p", 300)], CELLS)
    shares = spark.createDataFrame([("a", 3.0), ("b", 1.0)], "source string, target double")
    found = {r.source: r.weight for r in op4_mixing.cell_weights(cells, targets={"source": shares}).collect()}
    assert found == {"a": pytest.approx(300), "b": pytest.approx(100)}


def test_sample_meets_budget_and_margins(spark):
    rows = QUERIES["op4_mixing"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(op4_mixing.n_words().alias("n")).agg({"n": "sum"}).first()[0]
    assert sum(r.n_tokens for r in rows) == pytest.approx(op4_mixing.KEEP_TOKENS * docs, rel=0.1)
    assert sum(r.n_tokens * r.weight for r in rows) == pytest.approx(docs, rel=0.1)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, QUERIES["op4_mixing"](spark, SF).collect()))


def test_cells_at_their_limit_leave_the_margins_whole(spark):
    """Rare values that must give nearly all they hold still reach their targets, and so do the others."""
    rng = np.random.default_rng(6)
    cells = {(s, g, t): int(rng.integers(1, 900)) * (1 + 30 * (s == "a") * (g == "x")) for s in "abcd" for g in "xy" for t in "pqr"}
    total = sum(cells.values())
    raked, reached = op4_mixing.cell_tokens(spark.createDataFrame([(*k, v) for k, v in cells.items()], CELLS), 0.5)
    rows = raked.collect()
    assert all(0 <= r.given <= r.tokens for r in rows) and sum(r.given >= 0.9999 * r.tokens for r in rows) >= 3
    assert sum(r.given for r in rows) == pytest.approx(0.5 * total, rel=1e-3)
    for margin in op4_mixing.MARGINS:
        held = {}
        for r in rows:
            held[r[margin]] = held.get(r[margin], 0) + r.tokens
        powers = {v: n ** op4_mixing.TEMPERATURES[margin] for v, n in held.items()}
        want, fixed = {}, set()
        while True:  # what a value cannot give the others of its margin share
            left = 0.5 * total - sum(held[v] for v in fixed)
            scale = left / sum(p for v, p in powers.items() if v not in fixed)
            want = {v: held[v] if v in fixed else p * scale for v, p in powers.items()}
            over = {v for v in want if want[v] > held[v]}
            if not over:
                break
            fixed |= over
        for r in reached.where(f"margin = '{margin}'").collect():
            assert r.given == pytest.approx(want[r.value], rel=1e-3)
            assert r.asked == pytest.approx(powers[r.value] / sum(powers.values()) * 0.5 * total)


def test_targets_that_cannot_meet_together(spark):
    """Raking ends, the margins say what is off, and no cell gives more than it holds."""
    cells = spark.createDataFrame([("a", "x", "p", 900), ("a", "y", "p", 10), ("b", "x", "p", 40), ("b", "y", "p", 900)], CELLS)
    sources = spark.createDataFrame([("a", 9.0), ("b", 1.0)], "source string, target double")
    languages = spark.createDataFrame([("x", 1.0), ("y", 9.0)], "lang string, target double")
    raked, reached = op4_mixing.cell_tokens(cells, 0.4, targets={"source": sources, "lang": languages})
    assert all(0 <= r.given <= r.tokens for r in raked.collect())
    off = {(r.margin, r.value): abs(r.given - r.target) for r in reached.collect()}
    assert max(off.values()) > 100 and len(off) == 5


def test_raking_against_the_cells_meets_the_margins(spark):
    """Targets far from what the cells hold take more rounds than one query has; the result is the plain version's."""
    cells = {("a", "x", "p"): 1000, ("a", "y", "p"): 30, ("b", "x", "p"): 30, ("b", "y", "p"): 1000}
    shares = {"source": {"a": 0.8, "b": 0.2}, "lang": {"x": 0.2, "y": 0.8}}
    total = sum(cells.values())
    plain = rake(cells, [*({v: s * total for v, s in m.items()} for m in shares.values()), {"p": total}], rounds=5000)
    given = {m: spark.createDataFrame([*t.items()], f"{m} string, target double") for m, t in shares.items()}
    for r in op4_mixing.cell_weights(spark.createDataFrame([(*k, v) for k, v in cells.items()], CELLS), targets=given).collect():
        assert r.weight == pytest.approx(plain[r.source, r.lang, r.topic], rel=1e-3)


def test_all_margins_of_the_sample(spark):
    """Expected tokens meet every target, or all a value holds, and the sample is no further from that than chance allows."""
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op4_mixing"](spark, sf).select(*op4_mixing.MARGINS, "n_tokens", "probability").collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(
        "source", "lang", op4_mixing.form_topic().alias("topic"), op4_mixing.n_words().alias("n")).collect()
    chance = {tuple(r[:3]): r.probability for r in rows if r.n_tokens}
    budget = op4_mixing.KEEP_TOKENS * sum(d.n for d in docs)
    for margin in op4_mixing.MARGINS:
        held, expected, variance, got = {}, {}, {}, {}
        for d in docs:
            v, p = d[margin], chance.get(tuple(d[:3]), 0.0)
            held[v] = held.get(v, 0) + d.n
            expected[v] = expected.get(v, 0) + d.n * p
            variance[v] = variance.get(v, 0) + d.n**2 * p * (1 - p)
        for r in rows:
            got[r[margin]] = got.get(r[margin], 0) + r.n_tokens
        powers = {v: n ** op4_mixing.TEMPERATURES[margin] for v, n in held.items()}
        for v, p in powers.items():
            assert expected[v] == pytest.approx(min(held[v], budget * p / sum(powers.values())), rel=0.02), (margin, v)
            assert abs(got[v] - expected[v]) <= 5 * variance[v] ** 0.5 + 1, (margin, v)


def test_mixing_runs_no_python(spark):
    plan = QUERIES["op4_mixing"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_mixing_of_odd_rows(spark):
    docs = clashing(frame(spark), "topic", "weight", "factor", "target")
    rows = op4_mixing.sample(docs, keep_tokens=1.0).collect()
    assert {r.doc_id for r in rows} >= {4, 5, 6} and {r.target for r in rows} == {"x"}
    assert all(0 < r.probability <= 1 for r in rows) and len(rows) <= len(odd_rows())
    assert op4_mixing.sample(frame(spark, [])).count() == 0


# -- op 3 ------------------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def exact(rows, query, k=20):
    usable = {}
    for vec_id, v, *_ in rows:
        if vec_id is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        usable[vec_id] = np.array(v, np.float32).astype(float)
    found = []
    for q in sorted(usable):
        if query(q):
            order = sorted((-float(usable[q] @ v), i) for i, v in usable.items() if i != q)[:k]
            found += [(q, rank + 1, i, pytest.approx(-s, abs=1e-9)) for rank, (s, i) in enumerate(order)]
    return found


def test_few_vectors_are_exact_with_ties_and_unusable_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist(), 0) for i in range(30)]
    rows += [(i, rows[3][1], 0) for i in range(40, 70)]
    rows += [(80, None, 0), (81, [0.0] * 8, 0), (82, [float("nan")] * 8, 0), (83, [float("inf")] + [1.0] * 7, 0),
             (84, [None] + [1.0] * 7, 0), (None, [1.0] * 8, 0), (40, rows[3][1], None)]
    vectors = clashing(spark.createDataFrame(rows, VECTORS), "node", "rank", "score")
    from pyspark.sql import functions as F

    got = sorted(map(tuple, op3_neighbours.nearest(vectors, F.col("vec_id") % 20 == 0).collect()))
    assert got == exact(rows, lambda i: i % 20 == 0)


def test_no_vectors_and_one(spark):
    from pyspark.sql import functions as F

    for rows in ([], [(0, [1.0, 2.0], 0)]):
        assert op3_neighbours.nearest(spark.createDataFrame(rows, VECTORS), F.lit(True)).count() == 0


def test_recall(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    vectors = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS)
    settings = op3_neighbours.Settings(neighbours=20, block=100, blocks=3, rounds=4, beam=80, width=20, steps=4)
    rows = op3_neighbours.nearest(vectors, F.col("vec_id") % 20 == 0, s=settings).collect()
    near = x.astype(float) @ x.T.astype(float)
    np.fill_diagonal(near, -np.inf)
    hits = sum(near[r.query_id, r.vec_id] >= np.sort(near[r.query_id])[-20] for r in rows)
    assert len(rows) == 75 * 20 and hits >= 0.9 * len(rows)
