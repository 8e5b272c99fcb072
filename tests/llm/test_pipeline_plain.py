"""The pipeline against its five rules in plain Python: the documents after every stage, and the packed rows."""

import math
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallystar.llm.mixing import BLOCK_BYTES, TEMPERATURE
from tallystar.llm.packing import CAPACITY, Plan
from tallystar.llm.quality_classifier import LEAST_STRENGTH, MOST_STRENGTH, RIDGE, features
from tallystar.llm.spans import texts
from tallystar.llm.tables import in_written_order
from tallystar.sources.scratch import pin, scratch_path

from . import test_line_dedup, test_ngram_join
from .common import CLASHES, SCHEMA, awkward, documents
from .test_packing import TOKENIZER

NULL = -(2**63)


# --- the rules -------------------------------------------------------------------------------


def evidence(x, y):
    """Weights of a ridge logistic regression on standardised columns, by descent that only takes steps that gain."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-3

    def scaled(v):
        return np.column_stack([np.clip((v - mean) / spread, -8, 8), np.ones(len(v))])

    z, w = scaled(x), np.zeros(x.shape[1] + 1)
    hold = np.append(np.full(x.shape[1], RIDGE), 1e-3)

    def loss(v):
        return np.logaddexp(0, z @ v).sum() - y @ (z @ v) + 0.5 * hold @ (v * v)

    for _ in range(200):
        p = 1 / (1 + np.exp(-z @ w))
        slope = z.T @ (p - y) + hold * w
        if np.abs(slope).max() < 1e-9:
            break
        step, size = np.linalg.solve((z.T * (p * (1 - p))) @ z + np.diag(hold), slope), 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
    return lambda v: scaled(v) @ w


def strength(rates, counts, around):
    """Documents that a prior is worth: the rates' variance beyond chance is the usual one over that number and one."""
    n, r, a = (np.array(v, float) for v in (counts, rates, around))
    beyond = (n * ((r - a) ** 2 - a * (1 - a) / n)).sum() / n.sum()
    usual = (n * a * (1 - a)).sum() / n.sum()
    return max(usual / beyond - 1, LEAST_STRENGTH) if beyond > usual / MOST_STRENGTH else MOST_STRENGTH


def qualities(rows, labels):
    """Of each row: its own evidence freed from the general rate, over the rate of its site without it."""
    x = np.concatenate([features(t) for t in texts(pa.array([r["text"] or "" for r in rows], pa.large_string()).cast(pa.string()))])
    taught = sorted({r["doc_id"]: k for k, r in enumerate(rows) if r["doc_id"] in labels}.items(), key=lambda p: p[0])
    told = evidence(x[[k for _, k in taught]].astype(np.float32).astype(float), np.array([labels[i] for i, _ in taught], float))
    logit = told(x)
    p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    sites, hosts = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    keys = [(r["source"] or "", r["lang"] or "") for r in rows]
    for key, q in zip(keys, p, strict=True):
        for counts, k in ((sites, key), (hosts, key[0])):
            counts[k][0] += 1
            counts[k][1] += q
    prior = p.sum() / len(p)
    m_host = strength([k / n for n, k in hosts.values()], [n for n, _ in hosts.values()], [prior] * len(hosts))
    of_host = {h: (k + m_host * prior) / (n + m_host) for h, (n, k) in hosts.items()}
    m_path = strength([k / n for n, k in sites.values()], [n for n, _ in sites.values()], [of_host[h] for h, _ in sites])
    odds = lambda q: math.log(q / (1 - q))
    out = []
    for key, own, q in zip(keys, logit, p, strict=True):
        (n_host, k_host), (n_site, k_site) = hosts[key[0]], sites[key]
        host = (k_host - q + m_host * prior) / (n_host - 1 + m_host)
        site = (k_site - q + m_path * host) / (n_site - 1 + m_path)
        out.append(1 / (1 + math.exp(-(own - odds(prior) + odds(min(max(site, 1e-6), 1 - 1e-6))))))
    return out


def without_repeated_lines(rows):
    cut = defaultdict(list)
    for i, text, *_ in test_line_dedup.expected([(r["doc_id"], r["text"]) for r in rows], 20, 3):
        cut[i].append(text)
    return sorted((i, text, len(text)) for i, found in cut.items() for text in found)


def one_of_each_group(rows):
    """Of (id, text, length)."""
    groups = test_ngram_join.expected([(None if i == NULL else i, t) for i, t, _ in rows], 80, 5)
    own = {i for i, _, least in groups if i == least}
    return sorted({r for r in rows if r[0] in own})


def mixed(rows):
    """Rows (id, source, size, draw, checksum) in the order in which earliest deadlines deal the blocks of their sources."""
    placed, at = [], Counter()
    for i, source, size, draw, total in sorted(rows, key=lambda r: (r[1], r[3], r[0], r[4])):
        placed.append((source, at[source] // BLOCK_BYTES, at[source], i))
        at[source] += size
    left = {s: -(-n // BLOCK_BYTES) for s, n in at.items()}
    dealt, slots = Counter(), {}
    while left:
        weights = {s: Fraction(float(at[s]) ** TEMPERATURE) for s in left}
        share = {s: w / sum(weights.values()) for s, w in weights.items()}
        got, t = Counter(), 0
        while True:
            due = [(math.ceil((got[s] + 1) / share[s]), s) for s in share if math.floor(got[s] / share[s]) <= t]
            source = min(due)[1]
            if not left.get(source):
                break
            slots[source, dealt[source]] = len(slots)
            dealt[source] += 1
            got[source] += 1
            left[source] -= 1
            t += 1
        left = {s: n for s, n in left.items() if n}
    return [i for *_, i in sorted(placed, key=lambda r: (slots[r[0], r[1]], r[2]))]


def packed(rows):
    """(id, piece, start, length, checksum, sequence, offset) of (id, text) in their order."""
    pieces = []
    for i, text in rows:
        ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % CAPACITY or CAPACITY
        cuts = [0, *range(min(first, len(ids)), len(ids), CAPACITY), len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            pieces.append((i, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    plan = Plan(np.bincount([p[3] for p in pieces], minlength=CAPACITY + 1).astype(np.int64), CAPACITY)
    places = defaultdict(list)
    for length, rank, n, sequence, offset in zip(plan.length, plan.rank, plan.n, plan.sequence, plan.offset, strict=True):
        places[length] += [(rank + k, sequence + k, offset) for k in range(n)]
    ranks, out = Counter(), []
    for p in pieces:
        _, sequence, offset = sorted(places[p[3]])[ranks[p[3]]]
        ranks[p[3]] += 1
        out.append((*p, sequence, offset))
    return sorted(out)


# --- the tests -------------------------------------------------------------------------------


def ident(i):
    return NULL if i is None else i


@pytest.fixture(scope="module")
def run(spark, folder):
    """The folder's documents with awkward rows, near copies and shared lines; and what the pipeline makes of them."""
    path = scratch_path(spark)
    own = [r.asDict() for r in spark.read.parquet(f"{folder}/documents.parquet").select(*[f.name for f in SCHEMA]).collect()]
    more = [(None if i is None else 10**6 + i, t) for i, t in awkward()]
    long = max((r for r in own if r["text"] and 100 < len(r["text"].split()) < 400), key=lambda r: r["doc_id"])["text"]
    more += [(2 * 10**6 + k, long.replace(long.split()[50], f"changed{k}", 1)) for k in range(4)]
    more += [(3 * 10**6 + k, long[: 200 + k] + "\nA line that all of these share, long enough to be one.\n" + r["text"]) for k, r in enumerate(own[:3]) if r["text"]]
    extra = documents(spark, more)
    docs = spark.createDataFrame([tuple(r[f.name] for f in SCHEMA) for r in own], SCHEMA).unionByName(extra)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    kept = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(corpus_pipeline, "pin", lambda df: kept.append(pin(df)) or kept[-1])
        result = [tuple(r) for r in corpus_pipeline.run(spark, path).collect()]
    labels = defaultdict(int)
    for r in spark.read.parquet(f"{path}/labels.parquet").where("quality IS NOT NULL AND doc_id IS NOT NULL").collect():
        labels[r.doc_id] = max(labels[r.doc_id], r.quality)
    stages = [[r.asDict() for r in df.collect()] for df in kept]
    return [r.asDict() for r in docs.collect()], dict(labels), stages, kept, result


def triples(rows):
    return sorted((ident(r["doc_id"]), r["text"] or "", r["n_chars"]) for r in rows)


def test_the_classifier_keeps_what_the_rule_keeps(run):
    docs, labels, stages, *_ = run
    quality = qualities(docs, labels)
    assert min(abs(q - 0.5) for q in quality) > 1e-5  # no verdict hangs on rounding
    assert triples(stages[0]) == triples([r for r, q in zip(docs, quality, strict=True) if q >= 0.5])
    assert 0 < len(docs) - len(stages[0]) < len(docs) / 2


def test_lines_and_groups_are_those_of_the_rules(run):
    _, _, stages, *_ = run
    assert triples(stages[1]) == without_repeated_lines(stages[0])
    assert sum(len(r["text"] or "") for r in stages[1]) < sum(len(r["text"] or "") for r in stages[0])
    assert triples(stages[2]) == one_of_each_group(triples(stages[1]))
    assert len(stages[2]) < len(stages[1])


def test_the_mix_is_dealt_by_earliest_deadlines(spark, run):
    _, _, stages, kept, _ = run
    words = F.coalesce("text", F.lit(""))
    source, size = F.coalesce("source", F.lit("")), F.octet_length(words) + 1
    rows = kept[2].select("doc_id", source, size, F.xxhash64("doc_id", F.lit(3)), F.xxhash64(words)).collect()
    want = mixed([(ident(r[0]), *r[1:]) for r in rows])
    got = in_written_order(kept[3], "__f", "__r").orderBy("__f", "__r").collect()
    assert [ident(r.doc_id) for r in got] == want and triples(stages[3]) == triples(stages[2])


def test_the_pieces_lie_where_the_plan_puts_them(run):
    _, _, _, kept, result = run
    rows = in_written_order(kept[3], "__f", "__r").orderBy("__f", "__r").collect()
    assert sorted((ident(r[0]), *r[1:]) for r in result) == packed([(ident(r.doc_id), r.text) for r in rows])


def test_empty_tables_and_clashing_columns(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    for rows in ([], awkward()):
        path = scratch_path(spark)
        made = documents(spark, rows, clashes=True)
        made.write.parquet(f"{path}/documents.parquet")
        labels.limit(0).write.parquet(f"{path}/labels.parquet")
        plain = scratch_path(spark)
        made.drop(*[f"`{c}`" if "." in c else c for c in CLASHES]).write.parquet(f"{plain}/documents.parquet")
        labels.limit(0).write.parquet(f"{plain}/labels.parquet")
        out = corpus_pipeline.run(spark, path)
        assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        key = lambda r: tuple(ident(x) for x in r)
        assert sorted(map(key, out.collect())) == sorted(map(key, corpus_pipeline.run(spark, plain).collect()))
