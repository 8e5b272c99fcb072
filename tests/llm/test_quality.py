from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from tallystar.llm import quality_classifier, quality_rules

from .common import WORD, awkward, documents

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType())])


def base(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    runs = Counter(zip(words, words[1:], words[2:], strict=False))
    hit = [False] * len(words)
    for k in range(len(words) - 2):
        if runs[tuple(words[k : k + 3])] > 1:
            hit[k : k + 3] = [True] * 3
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, sum(hit)


def prose(rng, n, junk=False):
    words = [str(w) for w in rng.choice(["the", "of", "and", "to", "in", "a", "river", "stone", "walked", "house", "evening", "quiet", "found"], n)]
    return " | ".join(w.upper() + "###" for w in words) if junk else ". ".join(" ".join(words[k : k + 9]) for k in range(0, n, 9)).capitalize()


def test_base_counts_of_awkward_documents(spark):
    rows = [*awkward(), (20, "x y z x y z"), (21, "# | <b> $%& x"), (22, "l\nl\n l\n\n\nl"), (23, "the " * 60)]
    got = quality_rules.judge(documents(spark, rows, clashes=True)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    want = sorted(((i, *base(t)) for i, t in rows), key=key)
    assert sorted(((r.doc_id, *(r[c] for c in names)) for r in got), key=key) == want
    for r in got:
        fails = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == fails and not (fails and r.kept)
    assert quality_rules.judge(documents(spark, [])).count() == 0


def test_distances_against_a_plain_computation(spark):
    rng = np.random.default_rng(0)
    rows = [(i, prose(rng, int(rng.integers(60, 300)), junk=i % 20 == 0)) for i in range(120)]
    got = quality_rules.judge(documents(spark, rows)).collect()
    common = list(dict.fromkeys(quality_rules.COMMON_WORDS))

    def histogram(text):
        words = [w.lower() for w in WORD.findall(text)]
        return np.array([*(words.count(c) for c in common), sum(w not in common for w in words)], float)

    langs = {i: "en" if k % 3 else None for k, (i, _) in enumerate(rows)}
    whole = {lang: sum(histogram(t) for i, t in rows if langs[i] == lang) for lang in set(langs.values())}
    for r in got:
        p, q = histogram(dict(rows)[r.doc_id]), whole[langs[r.doc_id]]
        p, q = p / p.sum(), q / q.sum()
        m = (p + q) / 2
        js = sum((x[x > 0] * np.log2(x[x > 0] / m[x > 0])).sum() for x in (p, q)) / 2
        assert r.word_distance == pytest.approx(np.sqrt(js), abs=1e-6)
        assert r.kept == (r.doc_id % 20 != 0 and not r.base_failed)


def corpus(n, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, prose(rng, int(rng.integers(30, 200)), junk=bool(rng.random() < 0.2))) for i in range(n)]


def test_held_out_accuracy(spark):
    rows = corpus(600)
    truth = {i: 0 if "###" in t else 1 for i, t in rows}
    labels = spark.createDataFrame([(i, q) for i, q in truth.items() if i % 2], LABELS)
    got = quality_classifier.judge(documents(spark, rows), labels).collect()
    assert np.mean([r.kept == truth[r.doc_id] for r in got if r.doc_id % 2 == 0]) > 0.98


def test_sites_against_a_plain_computation(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), f"h{i % 5}", f"p{i % 3}", float(x), float(1 / (1 + np.exp(-x)))) for i, x in enumerate(rng.normal(1, 2, 200) + np.arange(200) % 5)]
    scored = spark.createDataFrame(rows, "doc_id long, host string, path string, logit double, p double")
    got = {r.doc_id: r for r in quality_classifier.with_sites(scored).collect()}
    p, host, path = (np.array(x) for x in ([r[4] for r in rows], [r[1] for r in rows], [f"{r[1]}/{r[2]}" for r in rows]))
    prior = p.mean()

    def strength(groups, around):
        names = list(dict.fromkeys(groups))
        n = np.array([(groups == g).sum() for g in names])
        rate = np.array([p[groups == g].mean() for g in names])
        a = np.array([around[g] for g in names])
        beyond, usual = (n * ((rate - a) ** 2 - a * (1 - a) / n)).sum() / n.sum(), (n * a * (1 - a)).sum() / n.sum()
        return max(usual / beyond - 1, 1.0) if beyond > usual / 1e6 else 1e6

    m_host = strength(host, dict.fromkeys(host, prior))
    rates = {h: (p[host == h].sum() + m_host * prior) / ((host == h).sum() + m_host) for h in set(host)}
    m_path = strength(path, {s: rates[s.split("/")[0]] for s in path})
    logit = lambda x: np.log(x / (1 - x))
    for i, r in got.items():
        h, s = host == host[i], path == path[i]
        host_rate = (p[h].sum() - p[i] + m_host * prior) / (h.sum() - 1 + m_host)
        site = (p[s].sum() - p[i] + m_path * host_rate) / (s.sum() - 1 + m_path)
        want = 1 / (1 + np.exp(-(rows[i][3] - logit(prior) + logit(site))))
        assert r.site_rate == pytest.approx(site, rel=1e-9) and r.quality == pytest.approx(want, rel=1e-9)


def test_sites_that_differ_flip_verdicts(spark):
    p = lambda x: float(1 / (1 + np.exp(-x)))
    rows = [(i, "good", "en", 3.0) for i in range(40)] + [(100 + i, "bad", "en", -3.0) for i in range(40)]
    # Undecided documents: one by itself leans to good on the bad host, one to bad on the good host, and the same two on a host of their own.
    rows += [(200, "bad", "en", 0.5), (201, "good", "en", -0.5), (202, "new1", "en", 0.5), (203, "new2", "en", -0.5)]
    scored = spark.createDataFrame([(*r, p(r[3])) for r in rows], "doc_id long, host string, path string, logit double, p double")
    quality = {r.doc_id: r.quality for r in quality_classifier.with_sites(scored).collect()}
    assert quality[200] < 0.5 < quality[201]
    assert quality[203] < 0.5 < quality[202]


def test_awkward_documents_and_no_labels(spark):
    labels = spark.createDataFrame([(1, 1), (6, 1), (6, 0), (8, 0), (None, 1), (10, None)], LABELS)
    df = documents(spark, awkward(), clashes=True)
    for given in (labels, labels.where("false")):
        got = quality_classifier.judge(df, given).collect()
        assert len(got) == len(awkward()) and all(0 <= r.quality <= 1 for r in got)
    assert quality_classifier.judge(documents(spark, []), labels).count() == 0


def test_rejected_documents_go(spark, tmp_path):
    rows = corpus(300)
    spark.createDataFrame([(i, 0 if "###" in t else 1) for i, t in rows], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    df = documents(spark, rows, clashes=True)
    kept = quality_classifier.stage(spark, df, str(tmp_path))
    assert kept.columns == df.columns
    good = {i for i, t in rows if "###" not in t}
    assert len({r.doc_id for r in kept.collect()} ^ good) <= 3
