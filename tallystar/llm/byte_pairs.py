"""Byte-level BPE by recursive queries of DuckDB, one small database in each task."""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
from collections.abc import Callable, Iterable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallystar.llm.pieces import Memory, Pieces
from tallystar.llm.spans import texts
from tallystar.llm.tables import plain, table

#: Different words a worker keeps; beyond that its memory of words starts anew.
MOST_WORDS = 900_000
#: Layout, not limits: bytes of words in a query, of texts encoded at once, and tokens in a query; and bytes of a word from which its steps, which
#: a query writes down one and all, would take too much room.
_WORD_BYTES = 1 << 17
_TEXT_BYTES = 4 << 20
_TOKENS = 1 << 18
_LONG_WORD = 256

_MERGES = """
create table merges as
with cut as (select id, bytes, unnest(range(1, octet_length(bytes))) as k from vocabulary where octet_length(bytes) > 1),
     parts as (select id, array_slice(bytes, 1, k) as a, array_slice(bytes, k + 1, octet_length(bytes)) as b from cut)
select l.id as l, r.id as r, parts.id as id
from parts join vocabulary l on l.bytes = parts.a join vocabulary r on r.bytes = parts.b
"""

# A row is a token of a word; ``merged`` is the token that it would form with the next one, whose id is its rank.
# Each step takes the least rank of a word, leftmost first, puts the merged token in place, closes the gap and looks
# up the two pairs that are new. A word without a pair has no further step.
_CONTRACT = """
with recursive steps as (
  select t.word, t.pos, t.id, m.id as merged, 0 as step from tokens t left join merges m on m.l = t.id and m.r = t.after
  union all
  select c.word, c.pos, c.id, case when c.beside is null then c.merged else m.id end, c.step
  from (
    select s.word, s.pos - (s.pos > f.pos)::int as pos, s.step + 1 as step,
      case when s.pos = f.pos then f.id else s.id end as id,
      case when s.pos = f.pos then f.after when s.pos = f.pos - 1 then f.id end as beside,
      case when s.pos = f.pos then null else s.merged end as merged
    from steps s join (
      select p.word, p.id, p.pos, a.id as after
      from (select word, (least_ // 65536)::int as id, (least_ % 65536)::int as pos
            from (select word, min(merged::bigint * 65536 + pos) as least_ from steps group by word)
            where least_ is not null) p
      left join steps a on a.word = p.word and a.pos = p.pos + 2) f on f.word = s.word
    where s.pos <> f.pos + 1
  ) c left join merges m on m.l = c.id and m.r = c.beside
)
select word, list(id order by pos) as ids
from steps join (select word, max(step) as step from steps group by word) using (word, step)
group by word order by word
"""

_DECODE = """
select text, list(bytes order by pos) as parts from ids join vocabulary using (id) group by text order by text
"""


def read_ranks(path: str) -> bytes:
    """The content of a file of ranks: a token in base64 and its rank, on each line."""
    with open(path, "rb") as file:
        return file.read()


class Codec:
    """Encodes and decodes by a table of ranks, which are the ids."""

    def __init__(self, ranks: bytes, pattern: str):
        import duckdb
        import regex

        pairs = [line.split() for line in ranks.splitlines() if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"bytes without a rank: {missing}")
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.split = regex.compile(pattern).findall
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "1GB", "temp_directory": "", "preserve_insertion_order": False})
        vocabulary = pa.table({"bytes": pa.array(list(self.ranks), pa.binary()), "id": pa.array(list(self.ranks.values()), pa.int32())})
        self._run("create table vocabulary as select * from given", given=vocabulary)
        self._run(_MERGES)
        self.known = np.zeros(max(self.ranks.values()) + 1, bool)
        self.known[list(self.ranks.values())] = True
        self.words = Memory()
        self.pieces = Pieces(self._learn)

    def _run(self, query: str, **tables: pa.Table) -> pa.Table | None:
        for name, rows in tables.items():
            self.db.register(name, rows)
        result = self.db.sql(query)
        out = None if result is None else result.to_arrow_table()
        for name in tables:
            self.db.unregister(name)
        return out

    def _contract(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, by the query: one word's after the other's, and how many each has."""
        lens = np.array([len(w) for w in words])
        ends = np.cumsum(lens)
        ids = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        after = np.append(ids[1:], -1)
        after[ends - 1] = -1
        tokens = pa.table(
            {
                "word": np.repeat(np.arange(len(words), dtype=np.int32), lens),
                "pos": (np.arange(len(ids)) - np.repeat(ends - lens, lens)).astype(np.int32),
                "id": ids,
                "after": after,
            }
        )
        lists = self._run(_CONTRACT, tokens=tokens).column("ids").combine_chunks()
        return lists.flatten().to_numpy(), lists.value_lengths().to_numpy()

    def _contract_long(self, word: bytes) -> np.ndarray:
        """The same for one long word, whose steps would fill a table with the square of its length."""
        token = [word[k : k + 1] for k in range(len(word))]
        after, before = [*range(1, len(word)), -1], [-1, *range(len(word) - 1)]

        def pair(k: int) -> tuple[int, int, bytes] | None:
            both = token[k] + token[after[k]] if after[k] >= 0 else b""
            return (self.ranks[both], k, both) if both in self.ranks else None

        heap = [p for p in map(pair, range(len(word))) if p]
        heapq.heapify(heap)
        while heap:
            _, k, both = heapq.heappop(heap)
            if not token[k] or after[k] < 0 or token[k] + token[after[k]] != both:
                continue  # one of the two is part of another token by now
            gone = after[k]
            token[k], token[gone], after[k] = both, b"", after[gone]
            if after[k] >= 0:
                before[after[k]] = k
            for changed in (before[k], k):
                if changed >= 0 and (p := pair(changed)):
                    heapq.heappush(heap, p)
        return np.array([self.ranks[t] for t in token if t], np.int32)

    def _learn(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different pieces of text, which the pattern splits into words."""
        split = [self.split(p.decode()) for p in pieces]
        if len(self.words.places) > MOST_WORDS:
            self.words = Memory()
        flat_words = [w for ws in split for w in ws]
        self._learn_words([w for w in dict.fromkeys(flat_words) if w not in self.words.places])
        ids, lens = self.words.get(flat_words)
        ends = np.concatenate([[0], np.cumsum(lens)])[np.cumsum([len(ws) for ws in split])]
        return ids, np.diff(ends, prepend=0)

    def _learn_words(self, words: list[str]) -> None:
        """Each different word is contracted once."""
        whole, todo, size = [], [], 0
        for word in words:
            coded = word.encode()
            if coded in self.ranks:
                whole.append((word, self.ranks[coded]))
            elif len(coded) >= _LONG_WORD:
                ids = self._contract_long(coded)
                self.words.put([word], ids, np.array([len(ids)]))
            else:
                todo.append((word, coded))
                size += len(coded)
                if size >= _WORD_BYTES:
                    self.words.put([w for w, _ in todo], *self._contract([c for _, c in todo]))
                    todo, size = [], 0
        if todo:
            self.words.put([w for w, _ in todo], *self._contract([c for _, c in todo]))
        if whole:
            self.words.put([w for w, _ in whole], np.array([i for _, i in whole], np.int32), np.ones(len(whole), np.int64))

    def decode(self, ids: np.ndarray, begins: np.ndarray) -> list[bytes]:
        """The bytes of lists of ids that lie one after the other."""
        out = [b""] * (len(begins) - 1)
        n = np.diff(begins)
        text = np.repeat(np.arange(len(n)), n).astype(np.int32)
        pos = (np.arange(len(ids)) - np.repeat(begins[:-1], n)).astype(np.int32)
        beyond = (ids < 0) | (ids >= len(self.known))
        unknown = np.flatnonzero(beyond | ~self.known[np.where(beyond, 0, ids)])
        if len(unknown):
            raise ValueError(f"no token has id {ids[unknown[0]]}")
        # Lists of many tokens are decoded in parts, so that a query has a bounded number of rows.
        cuts = np.append(np.arange(0, len(ids), _TOKENS), len(ids))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            rows = self._run(_DECODE, ids=pa.table({"text": text[a:b], "pos": pos[a:b], "id": ids[a:b].astype(np.int32)}))
            parts = rows.column("parts").combine_chunks()
            values = parts.flatten()
            data, at = values.buffers()[2], np.frombuffer(values.buffers()[1], np.int32 if values.type == pa.binary() else np.int64)[values.offset :]
            ends = at[np.cumsum(parts.value_lengths().to_numpy())]
            begin = int(at[0])
            for t, end in zip(rows.column("text").to_pylist(), ends.tolist(), strict=True):
                out[t] += data[begin:end].to_pybytes()
                begin = end
        return out


def _lists(ids: np.ndarray, begins: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(ids.astype(np.int32)))


def _encoding(codec: Callable[[], Codec]):
    """Batches of (key, text) to batches of (key, ids)."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec()
        for batch in batches:
            for some in texts(batch.column(1), _TEXT_BYTES):
                ids, begins = own.pieces.encode(some)
                yield pa.RecordBatch.from_arrays([batch.column(0)[some.rows.start : some.rows.stop], _lists(ids, begins)], ["key", "ids"])

    return encode


def _decoding(codec: Callable[[], Codec]):
    """Batches of (key, ids) to batches of (key, ids, bytes)."""

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec()
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(1)
            ids = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            begins = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.decode(ids, begins), pa.binary())], ["key", "ids", "bytes"])

    return decode


def _once(ranks: bytes, pattern: str) -> Callable[[], Codec]:
    """One codec for each Python worker, which keeps it, and the words that it has met, for its later tasks."""
    name = hashlib.sha256(ranks + pattern.encode()).hexdigest()

    def codec() -> Codec:
        # A module of the worker's own: the globals of a pickled function live no longer than its task.
        kept = vars(sys.modules.setdefault("tallystar_kept", ModuleType("tallystar_kept")))
        if name not in kept:
            kept[name] = Codec(ranks, pattern)
        return kept[name]

    return codec


def encode(documents: DataFrame, ranks: bytes, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its ``key`` and the ids of its text, as a list.

    Each match of ``pattern`` is a word of its own; its bytes are contracted pair by pair, the least rank first and the
    leftmost of equals, until no pair has a rank. A word that is a token is that token. What ``tiktoken`` calls special
    tokens is ordinary text.

    How: a task cuts its texts where no word reaches across; a worker keeps the ids of pieces and words it has met. New words
    are contracted by a recursive query of DuckDB: rows of (word, position, token) meet the table of
    merges, and each step contracts the leftmost pair of least rank in every word. Words of at least 256 bytes, whose
    steps would fill a table with the square of their length, are contracted by the same rule one by one.

    A null text is empty, an empty text has no ids; texts of any length are encoded whole, in slices of a batch. Rows
    that share a key, null keys and repeated rows are encoded each for itself. Other columns are not read; an empty table gives an
    empty result.
    """
    rows = documents.select(plain(key).alias("key"), plain(text).cast("string").alias("text"))
    out = rows.mapInArrow(_encoding(_once(ranks, pattern)), f"key {rows.schema[0].dataType.simpleString()}, ids array<int>")
    return out.withColumnRenamed("key", key)


def decode(encoded: DataFrame, ranks: bytes, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row its ``key``, its ids and the bytes that they stand for.

    How: rows of (text, position, id) meet the vocabulary in DuckDB, whose ordered aggregation puts the bytes together. A null or
    empty list gives no bytes; an id that no token has, and a null id, stop the job.
    """
    rows = encoded.select(plain(key).alias("key"), plain(ids).cast("array<int>").alias("ids"))
    out = rows.mapInArrow(_decoding(_once(ranks, pattern)), f"key {rows.schema[0].dataType.simpleString()}, ids array<int>, bytes binary")
    return out.withColumnsRenamed({"key": key, "ids": ids})


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        begins, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4")
        ids = [hashlib.sha256(values[a:b].tobytes()).hexdigest() for a, b in zip(begins[:-1], begins[1:], strict=True)]
        decoded = [hashlib.sha256(b).hexdigest() for b in batch.column("bytes").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(np.diff(begins).astype(np.int64)), pa.array(ids), pa.array(decoded)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def round_trip(documents: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """Per document the number of its tokens, and digests of its ids and of the bytes decoded from them.

    ``encode`` and ``decode`` in one task, so that the ids do not leave it.
    """
    codec = _once(ranks, pattern)
    into, back = _encoding(codec), _decoding(codec)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _digest(back(into(batches)))

    rows = documents.select(plain("doc_id").cast("long").alias("key"), plain("text").cast("string").alias("text"))
    return rows.mapInArrow(both, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
