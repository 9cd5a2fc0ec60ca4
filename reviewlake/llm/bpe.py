r"""Byte-level BPE: encoding and decoding by DuckDB queries inside each partition.

A text is cut into the matches of a pattern. Of each new word (match) of a batch there
is a row per byte, its token, the next one and its place. A recursive query joins the
pairs of neighbouring tokens with the merge table, takes each word's pair of the least
rank, the leftmost of equals, contracts it, and goes on with the words that changed until
none does. Decoding picks the pieces of each list of ids out of the vocabulary and joins them.

* Spark deals out the texts; nothing is shuffled. A worker keeps one database in memory,
  with the tables of the vocabulary, which are broadcast as the rank file (under 1 MB)
  and do not grow with the data.
* A space between two other characters always begins a match, so a text is split there,
  and the distinct chunks of many texts are looked up by a join with those met before. Only
  new ones are cut into words, in one go, and of these only new ones go to the query. Chunks
  and words are kept in a bounded table (a word by itself is cut into itself): what has not
  been seen since the table was last full is forgotten when it is full again.
* A round of the recursion adds what is left of each word to its result, so a query takes
  words of at most ``CELLS`` byte pairs, which bounds its memory whatever the words are.
* A text is taken in pieces of about ``PIECE`` characters, cut at such a space, so the
  memory does not grow with the text (only a text without any such space is one piece).

A word of over ``LONG`` bytes would take the recursion a round per merge over all its rows;
such words (none in prose) are contracted in the same order with a heap instead. A word
that is in the vocabulary as a whole is that token, found by a join.

Defined results: a null text is an empty text, which has no tokens; special tokens are
ordinary text; repeated rows get equal results; an empty table gives an empty result;
input columns named as a result column are replaced; ids that the vocabulary lacks, and
null ids, cannot be decoded and raise an error; null ``ids`` decode to no bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructType

from .common import table

PIECE = 700_000
#: Texts that are kept; once more, those seen before the table was last full.
CACHE = 200_000
#: Bytes of a text that is kept.
KEY = 128
#: Bytes of a word that the query takes; its numbers have six bits for the place in a word.
LONG = 64
CELLS = 2_000_000

#: A row's number g is 64 times its word's plus its place; a pair, the token's 2^20 times plus the next one's.
#: Of the two rows that are contracted the right one stays, since it has the token that follows.
ENCODE = """
with recursive whole as (select w::uinteger as w, id from words join vocabulary on piece = word),
t(g, pair, round) as (
  select g, pair, 0::utinyint from bytes_of_words anti join whole on (g >> 6) = w
  union all
  (with best as (
     select g >> 6 as w, min((rank << 6) + (g & 63)) as b from t join merges using (pair) group by 1)
   select g - ((g & 63) > (b & 63))::uinteger,
     case (g & 63)::integer - (b & 63)::integer
       when 1 then ((b >> 6)::ubigint << 20) + (pair & 1048575)
       when -1 then pair - (pair & 1048575) + (b >> 6)
       else pair end,
     round + 1::utinyint
   from t join best on (g >> 6) = w
   where (g & 63) <> (b & 63))
)
select (g >> 6)::bigint as w, (pair >> 20)::integer as tok, g
from t semi join (select g >> 6 as w, max(round) as round from t where (g & 63) = 0 group by 1) last
  on (g >> 6) = last.w and t.round = last.round
union all
select w, id, 0 from whole
order by w, g
"""

#: What follows the last token of a word; no pair has it.
END = (1 << 20) - 1

DECODE = """
select array_to_string(list_select(list, places), '') as text from tokens, pieces order by d
"""


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


class Runs:
    """Lists of ids, adjoining in ``flat``."""

    def __init__(self):
        self.flat, self.counts = np.empty(0, np.int32), np.empty(0, np.int64)

    def __len__(self) -> int:
        return len(self.counts)

    def add(self, flat: np.ndarray, counts: np.ndarray) -> None:
        self.flat, self.counts = np.concatenate([self.flat, flat]), np.concatenate([self.counts, counts])


class Recent:
    """Ids of texts that were met before: tables of texts and numbers of their runs.

    Once more than ``CACHE`` are new, they take the place of the old ones. Texts of over ``KEY`` bytes
    are not found again; their runs alone are held until then.
    """

    def __init__(self, db: duckdb.DuckDBPyConnection):
        self.db = db
        self.new, self.old = Runs(), Runs()
        for name in ("new_texts", "old_texts"):
            db.execute(f"create table {name} (text varchar, run integer)")

    def runs_of(self, texts: pa.StringArray) -> np.ndarray:
        """The number of each text's run among the new ones, -1 where it is not known. Old ones get new."""
        runs = self._look_up("new_texts", texts)
        if len(self.old) and len(lacking := np.flatnonzero(runs < 0)):
            some = texts.take(pa.array(lacking))
            in_old = self._look_up("old_texts", some)
            if len(met := np.flatnonzero(in_old >= 0)):
                # Texts may be repeated, but have one run each.
                which, first, place = np.unique(in_old[met], return_index=True, return_inverse=True)
                ids, _ = gathered(self.old.flat, self.old.counts, which)
                runs[lacking[met]] = self.add(some.take(pa.array(met[first])), ids, self.old.counts[which])[place]
        return runs

    def _look_up(self, name: str, texts: pa.StringArray) -> np.ndarray:
        self.db.register("sought", pa.table({"i": np.arange(len(texts), dtype=np.int32), "text": texts}))
        found = self.db.execute(f"select i, run from {name} join sought using (text)").fetchnumpy()
        runs = np.full(len(texts), -1, dtype=np.int64)
        runs[found["i"]] = found["run"]
        return runs

    def add(self, texts: pa.StringArray | list[str], flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Keeps the ids of more texts, and returns the numbers of their runs."""
        texts = pa.array(texts, pa.string())
        runs = np.arange(len(self.new), len(self.new) + len(texts))
        self.new.add(flat, counts)
        short = pc.less_equal(pc.binary_length(texts), KEY)
        self.db.register("given", pa.table({"text": texts, "run": runs.astype(np.int32)}).filter(short))
        self.db.execute("insert into new_texts select * from given")
        self.db.unregister("given")
        return runs

    def forget(self) -> None:
        """Much of what is new gets old. If its ids are more than texts of words have, nothing is kept."""
        large = self.new.flat.size > 16 * CACHE
        if len(self.new) > CACHE or large:
            self.db.execute("drop table old_texts")
            self.db.execute("alter table new_texts rename to old_texts")
            if large:
                self.db.execute("truncate old_texts")
            self.old, self.new = Runs() if large else self.new, Runs()
            self.db.execute("create table new_texts (text varchar, run integer)")


class Codec:
    """The vocabulary's tables in a database of this process."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}
        self.words = regex.compile(pattern)
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        self.max_id = max(self.ranks.values())
        self.decimal = np.array([str(i) for i in range(self.max_id + 1)], dtype=object)
        pairs = [
            ((self.ranks[token[:i]] << 20) + self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        self._load("merges", {"pair": pa.array([p for p, _ in pairs], pa.uint64()), "rank": pa.array([r for _, r in pairs], pa.uint32())})
        # A byte is the character of the same number: the database has no ordered aggregate of bytes.
        self._load(
            "vocabulary",
            {
                "id": pa.array(list(self.ranks.values()), pa.int32()),
                "piece": [token.decode("latin-1") for token in self.ranks],
            },
        )
        # The pieces in order of their ids, so that a list of ids picks its pieces.
        self.db.execute(
            """create table pieces as select list(coalesce(piece, '') order by i) as list
            from (select unnest(range((select max(id) + 1 from vocabulary))) as i) left join vocabulary on id = i"""
        )
        self.chunks = Recent(self.db)

    def _load(self, name: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"create table {name} as select * from given")
        self.db.unregister("given")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, whose sizes together are bounded."""
        if not texts:
            return []
        order, split = lists_of_chunks(texts)
        ends = split.offsets.to_numpy() - split.offsets[0].as_py()
        begins, chunks = ends[:-1], split.flatten()
        inner = np.ones(len(chunks), dtype=bool)
        inner[begins] = False
        others = chunks.filter(pa.array(inner)).dictionary_encode()
        spaced = pc.binary_join_element_wise(" ", others.dictionary, "")
        runs = self._runs_of(pa.concat_arrays([spaced, chunks.take(pa.array(begins))]))
        which = np.empty(len(chunks), dtype=np.int64)
        which[inner] = runs[others.indices.to_numpy()]
        which[begins] = runs[len(spaced) :]
        ids, until = gathered(self.chunks.new.flat, self.chunks.new.counts, which)
        self.chunks.forget()
        until = until[ends[1:] - 1].tolist()
        out: list[np.ndarray] = [ids[:0]] * len(texts)
        for i, start, end in zip(order, [0, *until[:-1]], until, strict=True):
            out[i] = ids[start:end]
        return out

    def _runs_of(self, chunks: pa.StringArray) -> np.ndarray:
        """The number of the run of ids of each chunk."""
        runs = self.chunks.runs_of(chunks)
        if len(lacking := np.flatnonzero(runs < 0)):
            texts = strings(chunks.take(pa.array(lacking)))
            found = self._learn(list(dict.fromkeys(texts)))
            runs[lacking] = np.fromiter(map(found.__getitem__, texts), np.int64, len(texts))
        return runs

    def _learn(self, chunks: list[str]) -> dict[str, int]:
        """The numbers of runs of distinct chunks that are not known, and of their words."""
        chunks, words, sizes = self._cut(chunks)
        distinct, unknown = dict.fromkeys(words), set(chunks)
        others = [w for w in distinct if w not in unknown]
        runs = self.chunks.runs_of(pa.array(others, pa.string())).tolist()
        found = {w: run for w, run in zip(others, runs, strict=True) if run >= 0}
        new = [w for w in distinct if w not in found]
        ids = self.encode_words([w.encode() for w in new])
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        found |= zip(new, self.chunks.add(new, np.frombuffer(b"".join(ids), np.int32), counts).tolist(), strict=True)
        # A chunk of one word is that word.
        several = sizes != 1
        which = np.fromiter(map(found.__getitem__, words), np.int64, len(words))[np.repeat(several, sizes)]
        flat, until = gathered(self.chunks.new.flat, self.chunks.new.counts, which)
        ends = np.concatenate([[0], until])[np.concatenate([[0], np.cumsum(sizes[several])])]
        some = [chunks[i] for i in np.flatnonzero(several).tolist()]
        found |= zip(some, self.chunks.add(some, flat, np.diff(ends)).tolist(), strict=True)
        return found

    def _cut(self, chunks: list[str]) -> tuple[list[str], list[str], np.ndarray]:
        """The chunks in another order, their words, and how many each has.

        Chunks that adjoin in a text are cut into words in one go, as they are in the text.
        """
        joined, apart = [], []
        for c in chunks:
            (joined if c[:1] == " " and not c[1:2].isspace() and not c[-1].isspace() else apart).append(c)
        words = self.words.findall("".join(joined))
        word_ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        until = np.searchsorted(word_ends, np.cumsum(np.fromiter(map(len, joined), np.int64, len(joined))), side="right").tolist()
        for chunk in apart:
            words += self.words.findall(chunk)
            until.append(len(words))
        return joined + apart, words, np.diff(np.array([0, *until], dtype=np.int64))

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as the bytes of 32-bit integers."""
        out: list[bytes | None] = [self.contract(w) if len(w) > LONG else None for w in words]
        rows = [i for i, ids in enumerate(out) if ids is None]
        for s in in_slices([len(words[i]) ** 2 for i in rows], CELLS):
            for i, ids in zip(rows[s], self._query([words[i] for i in rows[s]]), strict=True):
                out[i] = ids
        return out

    def _query(self, words: list[bytes]) -> list[bytes]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        places = np.arange(lengths.sum()) - np.repeat(ends - lengths, lengths)
        g = np.repeat(np.arange(len(words), dtype=np.int64) * LONG, lengths) + places
        tokens = self.byte[np.frombuffer(b"".join(words), np.uint8)].astype(np.uint64)
        following = np.append(tokens[1:], tokens[:1])
        following[ends - 1] = END
        pairs = (tokens << np.uint64(20)) + following
        self.db.register("bytes_of_words", pa.table({"g": g.astype(np.uint32), "pair": pairs}))
        texts = [w.decode("latin-1") for w in words]
        self.db.register("words", pa.table({"w": np.arange(len(words)), "word": pa.array(texts, pa.string())}))
        found = self.db.execute(ENCODE).fetchnumpy()
        ids = found["tok"].astype(np.int32).tobytes()
        ends = np.searchsorted(found["w"], np.arange(len(words)), side="right") * 4
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def contract(self, word: bytes) -> bytes:
        """The ids of a long word: the same contractions, with a heap of pairs."""
        if (rank := self.ranks.get(word)) is not None:
            return rank.to_bytes(4, "little")
        parts: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
        left, right = list(range(-1, len(word) - 1)), [*range(1, len(word)), -1]
        heap = [
            (rank, i) for i in range(len(word) - 1) if (rank := self.ranks.get(word[i : i + 2])) is not None
        ]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = right[i] if parts[i] is not None else -1
            if j < 0 or self.ranks.get(parts[i] + parts[j]) != rank:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            right[i] = right[j]
            if right[i] >= 0:
                left[right[i]] = i
            for a in (left[i], i):
                b = right[a] if a >= 0 else -1
                if b >= 0 and (next_rank := self.ranks.get(parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (next_rank, a))
        return np.array([self.ranks[p] for p in parts if p is not None], dtype=np.int32).tobytes()

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each list of ids, whose sizes together are bounded."""
        if not any(map(len, ids)):
            return [b""] * len(ids)
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        places = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids) + np.int32(1), pa.int32()))
        self.db.register("tokens", pa.table({"d": np.arange(len(ids)), "places": places}))
        texts = self.db.sql(DECODE).to_arrow_table()["text"]
        return [text.encode("latin-1") for text in texts.to_pylist()]


BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
UNSAFE = re.compile(r"\s ")


def chunks_of(text: str) -> list[str]:
    """Parts of the text that are cut into matches independently of each other."""
    if UNSAFE.search(text) or " \n" in text or text[:1] == " " or text[-1:] == " ":
        ends = [m.start() for m in BOUNDARY.finditer(text)]
        return [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)], strict=True)] if text else []
    first, *others = text.split(" ")
    return [first, *[" " + c for c in others]] if text else []


def lists_of_chunks(texts: list[str]) -> tuple[list[int], pa.ListArray]:
    """Numbers of the texts, and in this order their chunks, one at least, without the space each but the first begins with."""
    odd, plain, lists = [], [], []
    for i, text in enumerate(texts):
        if UNSAFE.search(text) or " \n" in text or text[:1] == " " or text[-1:] == " ":
            first, *others = chunks_of(text)
            odd.append(i)
            lists.append([first, *[c[1:] for c in others]])
        else:
            plain.append(i)
    split = pc.split_pattern(pa.array([texts[i] for i in plain], pa.string()), " ")
    return plain + odd, pa.concat_arrays([split, pa.array(lists, split.type)])


def strings(texts: pa.StringArray) -> list[str]:
    # Many times as fast as to_pylist().
    return texts.to_numpy(zero_copy_only=False).tolist()


def gathered(flat: np.ndarray, counts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of runs of ``flat`` that adjoin those of the numbers ``which``, in this order, and the end of each."""
    taken = counts[which]
    until = np.cumsum(taken)
    # Slices are bounded, so that places in them fit into 32 bits, which halves what is held.
    shift = ((np.cumsum(counts) - counts)[which] - (until - taken)).astype(np.int32)
    return flat[np.repeat(shift, taken) + np.arange(until[-1] if len(until) else 0, dtype=np.int32)], until


def pieces_of(text: str, size: int = PIECE) -> Iterator[str]:
    """The text, cut at a boundary about every ``size`` characters."""
    start = 0
    while len(text) - start > size and (m := BOUNDARY.search(text, start + size)):
        yield text[start : m.start()]
        start = m.start()
    yield text[start:] if start else text


def in_slices(sizes: list[int], most: int) -> Iterator[slice]:
    """Runs of items whose sizes together are about ``most``."""
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield slice(start, len(sizes))


CODECS: dict[tuple[str, str], Codec] = {}


def codec(rank_file: bytes, pattern: str) -> Codec:
    """One codec per worker process and vocabulary."""
    key = hashlib.sha256(rank_file).hexdigest(), pattern
    if key not in CODECS:
        CODECS.clear()
        CODECS[key] = Codec(rank_file, pattern)
    return CODECS[key]


def encode_all(coder: Codec, texts: list[str | None]) -> Iterator[np.ndarray]:
    texts = ["" if t is None else t for t in texts]
    for s in in_slices([len(t) for t in texts], PIECE):
        pieces = [list(pieces_of(t)) for t in texts[s]]
        if any(len(p) > 1 for p in pieces):
            for parts in pieces:
                yield np.concatenate([coder.encode([p])[0] for p in parts])
        else:
            yield from coder.encode([p[0] for p in pieces])


def decode_all(coder: Codec, ids: list[np.ndarray]) -> Iterator[bytes]:
    for some in ids:
        if len(some) and (some.min() < 0 or some.max() > coder.max_id):
            raise ValueError("an id is not in the vocabulary")
    for s in in_slices([len(x) for x in ids], PIECE // 4):
        if s.stop - s.start == 1:
            some = ids[s.start]
            yield b"".join(coder.decode([some[i : i + PIECE // 4]])[0] for i in range(0, len(some), PIECE // 4))
        else:
            yield from coder.decode(ids[s])


def id_lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, np.int32), *ids]), pa.int32()))


def with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n.lower() != name.lower()]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], values], [*names, name])


def schema_with(df: DataFrame, name: str, kind) -> StructType:
    return StructType([f for f in df.schema.fields if f.name.lower() != name.lower()]).add(name, kind)


def encode(df: DataFrame, ranks_path: str, pattern: str, column: str = "text", to: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``column``."""
    file = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coder = codec(file.value, pattern)
            ids = list(encode_all(coder, batch.column(column).to_pylist()))
            yield with_column(batch, to, id_lists(ids))

    return df.mapInArrow(run, schema_with(df, to, ArrayType(IntegerType())))


def decode(df: DataFrame, ranks_path: str, pattern: str, column: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids of ``column`` stand for."""
    file = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coder = codec(file.value, pattern)
            ids = [np.array(x or [], dtype=np.int32) for x in batch.column(column).to_pylist()]
            yield with_column(batch, to, pa.array(list(decode_all(coder, ids)), pa.binary()))

    return df.mapInArrow(run, schema_with(df, to, BinaryType()))


def digests(
    df: DataFrame, ranks_path: str, pattern: str, column: str = "text", ids_too: bool = False
) -> DataFrame:
    """Every other column of ``df``, ``n_tokens, ids_sha256, decoded_sha256``, and ``ids`` if wanted.

    Encodes, and decodes the ids, in one pass, so that one worker does both.
    """
    new = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids_too]
    file = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kept = [c for c in df.columns if c.lower() not in new and c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coder = codec(file.value, pattern)
            texts = batch.column(column)
            counts, of_ids, of_bytes, flat = [], [], [], []
            for s in in_slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), PIECE):
                ids = list(encode_all(coder, texts[s].to_pylist()))
                counts += map(len, ids)
                of_ids += [sha256(" ".join(coder.decimal[x].tolist()).encode()) for x in ids]
                of_bytes += map(sha256, decode_all(coder, ids))
                flat += ids if ids_too else []
                del ids
                # Else what a slice took is held for the next ones, and by a worker that waits.
                pa.default_memory_pool().release_unused()
            found = [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
            if ids_too:
                found.append(id_lists(flat))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *found], [*kept, *new])
            # The worker may wait for its next batch or task, so it gives back what it does not hold.
            del texts, found, flat, batch
            pa.default_memory_pool().release_unused()

    out = StructType([df.schema[c] for c in kept])
    out = out.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return df.mapInArrow(run, out.add("ids", ArrayType(IntegerType())) if ids_too else out)


def sha256(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES = {"op5_byte_bpe": (op5_byte_bpe, None)}
