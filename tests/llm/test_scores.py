from __future__ import annotations

import collections
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from sedimenta.llm import op1_quality, op5_jaccard_join, op6_divergence, op8_pseudo_likelihood, op10_toxicity
from sedimenta.llm.queries import QUERIES

from .cases import clashing, frame, odd_rows, prose

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = collections.Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, again, len(inside)


# -- op 6 ------------------------------------------------------------------------------------------------------------


def test_base_rules_equal_the_plain_version(spark):
    rows = [*odd_rows(), (20, "a | b\na | b\n\n \na | b", "en", "s", 1), (21, "x y z x y z w", None, "s", 1)]
    found = op6_divergence.judge(clashing(frame(spark, rows), "kept", "n_words", "part", "bin"))
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                              for r in found.collect())
    want = collections.Counter()
    for doc_id, text, *_ in rows:
        n, *others = base_counts(text)
        want[doc_id, n, *others, n < 50 or 100 * others[-1] > 50 * n] += 1
    assert got == want


def test_divergence_of_known_histograms():
    p = np.array([[0.5, 0.5, 0.0], [0.0, 0.0, 1.0], [0.0, 0.0, 0.0]])
    got = op6_divergence.jensen_shannon(p, np.array([0.5, 0.5, 0.0]))
    assert np.allclose(got, [0, 1, 0])


def test_divergence_equals_the_plain_version(spark):
    rows = [(k, prose(k, 80), "en" if k % 2 else "de", "s", 1) for k in range(6)]
    found = {r.doc_id: r for r in op6_divergence.judge(frame(spark, rows)).collect()}
    for lang in ("en", "de"):
        texts = {r[0]: r[1] for r in rows if r[2] == lang}
        classes = {k: collections.Counter(
            "v" if c in "aeiou" else " " if c == " " else "l" for c in t) for k, t in texts.items()}
        total = sum(classes.values(), collections.Counter())
        for k, mine in classes.items():
            keys = sorted(total)
            p = np.array([mine[x] for x in keys]) / mine.total()
            q = np.array([total[x] for x in keys]) / total.total()
            m = (p + q) / 2
            want = (p * np.log2(p / m)).sum() / 2 + (q * np.log2(q / m)).sum() / 2
            assert found[k].character_divergence == pytest.approx(want)


def test_strings_that_a_sum_of_powers_confuses(spark):
    """Two different strings of 1,024 letters, in the order of a bit count's parity, are different words, lines and sets."""
    one = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    two = "".join("ba"[bin(k).count("1") % 2] for k in range(1024))
    row = op6_divergence.judge(frame(spark, [(1, f"{one}\n{two}", "en", "s", 1)])).first()
    assert (row.n_words, row.n_dup_lines, row.n_repeat_words) == (2, 0, 0)
    sets = op5_jaccard_join.components(frame(spark, [(1, one, "en", "s", 1), (2, two, "en", "s", 1)])).collect()
    assert {r.doc_id: r.component_id for r in sets} == {1: 1, 2: 2}


def test_rules_on_an_empty_table(spark):
    assert op6_divergence.judge(frame(spark, [])).count() == 0


def test_rules_keep_clean_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op6_divergence"](spark, SF).join(labels, "doc_id").where("not base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) < 0.3 * len(bad)


def test_every_language_has_its_own_reference(spark):
    """Documents of 300 small languages, each with words and letters of its own, are all close to their language."""
    rows = [(900 + k, "abc def ghi jkl " * 4 + prose(k, 120), "en", "s", 1) for k in range(6)]
    rows += [(k, " ".join(f"{chr(0x4E00 + k)}{'1' * (w % 5)}{w}" for w in range(80)), f"l{k}", "s", 1) for k in range(300)]
    found = {r.doc_id: r for r in op6_divergence.judge(frame(spark, rows)).collect()}
    assert len(found) == len(rows)
    assert all(found[k].kept and found[k].character_divergence == pytest.approx(0) and found[k].word_divergence == pytest.approx(0)
               for k in range(300))


def test_tables_and_languages_without_words(spark):
    nothing = [(1, None, "en", "s", 1), (2, "", None, "s", 1), (3, " ", "de", "s", 1)]
    for rows in (nothing, [*nothing, (4, prose(1), "fr", "s", 1)]):
        found = {r.doc_id: r for r in op6_divergence.judge(frame(spark, rows)).collect()}
        assert all((found[k].kept, found[k].character_divergence, found[k].word_divergence) == (False, 0, 0) for k in (1, 2, 3))


# -- op 1 ------------------------------------------------------------------------------------------------------------


def test_quality_holds_on_labels_it_has_not_seen(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    unseen = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    rows = op1_quality.judge(docs, labels.where(~unseen)).join(labels.where(unseen), "doc_id").select("quality", "kept").collect()
    right = sum(r.kept == bool(r.quality) for r in rows)
    assert len(rows) > 80 and right >= 0.95 * len(rows)


def test_sparse_sites_shrink_to_their_host(spark):
    rows = [("good", "a", 0.9)] * 400 + [("good", "b", 0.1)] + [("bad", "a", 0.2)] * 400 + [("new", "a", 0.1)]
    found, mean, strength = op1_quality.sites(spark.createDataFrame(rows, "host string, path string, p double"))
    at = {(r.host, r.path): r for r in found.collect()}
    assert mean == pytest.approx(sum(r[2] for r in rows) / len(rows))
    assert at["good", "a"].host_mean > 0.85 and at["bad", "a"].host_mean < 0.25
    assert abs(at["new", "a"].host_mean - mean) < abs(at["new", "a"].host_mean - 0.1)
    assert strength >= 1


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0), (None, 1, 0), (9, None, 0)], "doc_id long, quality int, toxic int")
    found = op1_quality.judge(clashing(frame(spark), "kept", "host", "path", "n", "log_odds"), labels)
    rows = found.collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r.probability <= 1 for r in rows)
    assert {r.host for r in rows} == {"x"}
    nothing = op1_quality.judge(frame(spark), labels.where("false")).collect()
    assert all(r.kept for r in nothing)
    assert op1_quality.judge(frame(spark, []), labels).count() == 0


# -- op 10 -----------------------------------------------------------------------------------------------------------


def test_toxicity_on_held_out_documents(spark):
    large = "/root/testdata/sf0.1"
    rows = QUERIES["op10_toxicity"](spark, large).join(spark.read.parquet(f"{large}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    wrong = sum(r.predicted != r.toxic for r in held)
    assert len(held) > 100 and wrong <= 0.03 * len(held)
    assert all(r.predicted == (r.score >= 0.7) for r in rows)


def test_repeated_ids_do_not_widen_the_training_sample(spark, monkeypatch):
    """A labelled doc_id on a thousand rows trains as one document, the same whatever the rows' order."""
    seen = []
    monkeypatch.setattr(op10_toxicity, "fit", lambda texts, y: seen.append((sorted(texts.to_pylist()), sorted(y.tolist()))))
    rows = [(1, f"repeated text {k}", "en", "s", 1) for k in range(1000)] + [(2, "another text", "en", "s", 1)]
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    for some in (rows, rows[::-1]):
        op10_toxicity.train(frame(spark, some), labels, max_docs=10)
    assert seen[0] == seen[1] and len(seen[0][0]) == 2


def test_noisy_or_and_offending_sentences(spark):
    rng = np.random.default_rng(0)
    texts, labels = [], []
    for k in range(400):
        sentences = [" ".join(f"w{x}" for x in rng.integers(0, 40, 8)) for _ in range(5)]
        if k % 3 == 0:
            sentences[k % 5] += " villain"
        texts.append(". ".join(sentences).replace("w", "q"))
        labels.append(int(k % 3 == 0))
    model = op10_toxicity.fit(pa.array([t.replace("villain", "nasty") for t in texts]), np.array(labels))
    rows = [(1, "kind words. a nasty one! more", "en", "s", 1), (2, "kind words", "en", "s", 1), (3, None, "en", "s", 1), (4, "", "en", "s", 1)]
    found = {r.doc_id: r for r in op10_toxicity.score(frame(spark, rows), model).collect()}
    assert found[1].predicted == 1 and found[2].predicted == 0
    assert [(s.start, s.stop) for s in found[1].offending] == [(11, 24)]
    assert 0 <= found[3].score == found[4].score < 0.01
    odds = np.array([-1.0, 0.5, 2.0])
    p = 1 / (1 + np.exp(-odds))
    assert op10_toxicity.noisy_or(odds, np.array([0, 0, 1]), 2) == pytest.approx([1 - (1 - p[0]) * (1 - p[1]), p[2]])


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (None, 1, 1), (9, 1, None)], "doc_id long, quality int, toxic int")
    docs = clashing(frame(spark), "score", "toxic", "offending")
    rows = op10_toxicity.score(docs, op10_toxicity.train(docs, labels)).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r.score <= 1 for r in rows)
    model = op10_toxicity.train(docs, labels.where("false"))
    assert op10_toxicity.score(frame(spark, []), model).count() == 0


# -- op 8 ------------------------------------------------------------------------------------------------------------


def test_gradient_is_that_of_the_mean():
    rng = np.random.default_rng(0)
    network = op8_pseudo_likelihood.Network.fresh(np.arange(op8_pseudo_likelihood.BINS) % op8_pseudo_likelihood.TOKENS)
    network.weights = {k: v.astype(float) for k, v in network.weights.items()}
    y = rng.integers(0, op8_pseudo_likelihood.TOKENS, 40)
    around = rng.integers(0, op8_pseudo_likelihood.TOKENS + 1, (4, 40))
    gradient = network.gradient(y, around)
    for name, weights in network.weights.items():
        at = np.unravel_index(np.abs(gradient[name]).argmax(), weights.shape)
        values = []
        for step in (1e-5, -2e-5):
            weights[at] += step
            values.append(-network._forward(y, around)[4].mean())
        assert (values[0] - values[1]) / 2e-5 == pytest.approx(gradient[name][at], rel=1e-3)


def test_probabilities_add_up_to_one():
    m = op8_pseudo_likelihood
    network = m.Network.fresh(np.arange(m.BINS) % m.TOKENS)
    around = np.repeat(np.array([[3], [m.TOKENS], [9], [11]]), m.TOKENS, axis=1)
    assert np.exp(network.log_probabilities(np.arange(m.TOKENS), around)).sum() == pytest.approx(1, abs=1e-4)


def row_wise(network, y, around):
    """The network by the formula, a row for each word: log-probabilities, and the parts of their mean's gradient."""
    m, w = op8_pseudo_likelihood, network.weights
    h = np.tanh(w["bias"] + sum(w["near"][k][around[k]] for k in range(2 * m.REACH)))
    logs, back, rows = 0.0, 0.0, np.arange(len(y))
    out = {}
    for name, bias, digit in (("high", w["high_bias"], y // m.DIGIT), ("low", w["low_bias"][y // m.DIGIT], y % m.DIGIT)):
        z = h @ w[name] + bias
        z -= z.max(axis=1, keepdims=True)
        shares = np.exp(z)
        total = shares.sum(axis=1, keepdims=True)
        logs = logs + z[rows, digit] - np.log(total[:, 0])
        shares /= total
        shares[rows, digit] -= 1
        shares /= len(y)
        out[name] = h.T @ shares
        back = back + shares @ w[name].T
        out[f"{name}_bias"] = shares
    out["high_bias"], low = out["high_bias"].sum(axis=0), out["low_bias"]
    out["low_bias"] = np.stack([low[y // m.DIGIT == k].sum(axis=0) for k in range(m.DIGIT)])
    back = back * (1 - h * h)
    near = np.zeros_like(w["near"])
    for k in range(2 * m.REACH):
        np.add.at(near[k], around[k], back)
    return logs, out | {"near": near, "bias": back.sum(axis=0)}


def random_words(n):
    m, rng = op8_pseudo_likelihood, np.random.default_rng(5)
    return rng.integers(0, m.TOKENS, n), rng.integers(0, m.TOKENS + 1, (2 * m.REACH, n))


def test_network_equals_the_formula():
    m = op8_pseudo_likelihood
    network = m.Network.fresh(np.arange(m.BINS) % m.TOKENS)
    for n in (1, 7, m.BATCH + 3):
        y, around = random_words(n)
        logs, gradient = row_wise(network, y, around)
        assert network.log_probabilities(y, around) == pytest.approx(logs, abs=1e-5)
        found = network.gradient(y, around)
        assert found.keys() == gradient.keys() == network.weights.keys()
        for name, part in gradient.items():
            assert found[name].shape == part.shape
            assert np.abs(found[name] - part).max() < 1e-5 * max(1, np.abs(part).max()), name


def test_probabilities_take_less_time_than_row_by_row():
    """The network is most of the query's Python time: softmaxes go along the words, not along 32 values at a time."""
    m = op8_pseudo_likelihood
    network = m.Network.fresh(np.arange(m.BINS) % m.TOKENS)
    y, around = random_words(m.BATCH)
    w, rows = network.weights, np.arange(len(y))

    def plain():
        h = np.tanh(w["bias"] + sum(w["near"][k][around[k]] for k in range(2 * m.REACH)))
        logs = np.zeros(len(y))
        for z, digit in ((h @ w["high"] + w["high_bias"], y // m.DIGIT),
                         (h @ w["low"] + w["low_bias"][y // m.DIGIT], y % m.DIGIT)):
            z -= z.max(axis=1, keepdims=True)
            logs += z[rows, digit] - np.log(np.exp(z).sum(axis=1))
        return logs

    def least(run):
        times = []
        for _ in range(25):
            before = time.thread_time()
            run()
            times.append(time.thread_time() - before)
        return min(times)

    assert network.log_probabilities(y, around) == pytest.approx(plain(), abs=1e-5)
    assert least(lambda: network.log_probabilities(y, around)) < 0.85 * least(plain)


def test_sums_of_documents_are_those_of_a_plain_loop(spark):
    m = op8_pseudo_likelihood
    rows = [(k, t, "en", "s", 1) for k, t in enumerate(["b a b  c", None, "", "A b\tb a d", "c c c", "b a b  c", "e"] * 2)]
    docs = frame(spark, rows)
    counts = m.stage_lean(m.word_counts(docs), "counts")
    number = {r.word: (r.hash, r.n) for r in counts.collect()}
    network = m.train(docs, counts=counts)
    sizes = collections.Counter()
    for h, n in number.values():
        sizes[network.token[h % m.BINS]] += n
    for frequent in (m.FREQUENT, 1):  # by the table in the worker and by the join
        m.FREQUENT, before = frequent, m.FREQUENT
        try:
            found = {r.doc_id: r for r in m.score(docs, network, counts).collect()}
        finally:
            m.FREQUENT = before
        for doc_id, text, *_ in rows:
            words = [w.lower() for w in WORD.findall(text or "")]
            y = np.array([network.token[number[w][0] % m.BINS] for w in words], np.int64)
            around = np.array([[y[i + s] if 0 <= i + s < len(y) else m.TOKENS for i in range(len(y))]
                               for s in (*range(-m.REACH, 0), *range(1, m.REACH + 1))], np.int64)
            expected = 0.0
            if words:
                expected = row_wise(network, y, around)[0].sum() + sum(
                    np.log(number[w][1] / (sizes[t] + 1)) for w, t in zip(words, y))
            assert found[doc_id].n_words == len(words)
            assert found[doc_id].log_likelihood == pytest.approx(expected, abs=1e-4)


def test_trained_network_prefers_what_it_has_seen(spark):
    rows = [(k, "one two three four five six seven eight " * 60, "en", "s", 1) for k in range(24)]
    rows += [(100, "eight three one seven two six five four " * 60, "en", "s", 1), (101, None, "en", "s", 1), (102, "", "en", "s", 1)]
    docs = clashing(frame(spark, rows), "n_words", "log_likelihood", "place")
    network = op8_pseudo_likelihood.train(docs.where("doc_id < 50"))
    found = {r.doc_id: r for r in op8_pseudo_likelihood.score(docs, network).collect()}
    fresh = op8_pseudo_likelihood.Network.fresh(network.token)
    before = {r.doc_id: r for r in op8_pseudo_likelihood.score(docs, fresh).collect()}
    assert found[1].mean_log_likelihood > before[1].mean_log_likelihood
    assert found[1].mean_log_likelihood > found[100].mean_log_likelihood
    assert found[1].log_likelihood == pytest.approx(480 * found[1].mean_log_likelihood)
    assert (found[101].n_words, found[101].log_likelihood, found[101].mean_log_likelihood) == (0, 0.0, None)
    assert found[102].mean_log_likelihood is None


def test_network_of_odd_and_no_rows(spark):
    assert op8_pseudo_likelihood.score(frame(spark), op8_pseudo_likelihood.train(frame(spark))).count() == len(odd_rows())
    empty = frame(spark, [])
    assert op8_pseudo_likelihood.score(empty, op8_pseudo_likelihood.train(empty)).count() == 0


def test_every_distinct_word_has_its_own_probability(spark):
    """Among words of one shared token a frequent one is likelier than a rare one, and all shares add up to one."""
    m = op8_pseudo_likelihood
    token = np.zeros(m.BINS, np.int64)
    network = m.Network.fresh(token)
    corpus = frame(spark, [(1, "often " * 90 + "Seldom " * 9, "en", "s", 1), (2, "never", "en", "s", 1)])
    counts = m.stage_lean(m.word_counts(corpus), "counts")
    assert {r.word: r.n for r in counts.collect()} == {"often": 90, "seldom": 9, "never": 1}
    rows = [(k, w, "en", "s", 1) for k, w in enumerate(["often", "seldom", "never", "unseen"])]
    for frequent in (m.FREQUENT, 2):  # by the table in the worker and by the join
        m.FREQUENT, before = frequent, m.FREQUENT
        try:
            found = {r.doc_id: r.log_likelihood for r in m.score(frame(spark, rows), network, counts).collect()}
        finally:
            m.FREQUENT = before
        nothing = m.Network.fresh(token).log_probabilities(np.zeros(1, np.int64), np.full((2 * m.REACH, 1), m.TOKENS))[0]
        assert [np.exp(found[k] - nothing) for k in range(4)] == pytest.approx([90 / 101, 9 / 101, 1 / 101, 1 / 101])
