"""Best-fit packing of token sequences with certified repacking.

Texts become token ids and an end id; only those longer than a sequence are cut. Pieces are dealt to
partitions of a bounded size, each packs its own by best-fit decreasing, and lower bounds from dual-feasible
functions certify the number of sequences. While the total is above the bound of all lengths together, the
pieces of sequences with gaps are dealt anew, so that partitions exchange documents, and packed again; a
round that saves nothing ends the search.
"""

from __future__ import annotations

import gc
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.llm.common import materialise, partitions_for, ship
from moodstream.llm.lockstep import PairMerges, by_length

CAPACITY = 4096
END_ID = 1
PIECES_PER_PARTITION = 50_000
ROUNDS = 6
CACHED_CHUNKS = 450_000

#: Letters that lower-casing and composition leave alone or map one to one; other chunks take the library's way.
_PLAIN = re.compile("[!-~À-įı-ſ]+").fullmatch
_LOW = "a-zß-öø-ſ"
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LOW}]+|[0-9]|[^\\s{_LOW}0-9]+").findall
#: Chunks of more letters go to the library, whose time grows in proportion to their length.
LONGEST_CHUNK = 1_000
#: What the file must say for chunks to have ids of their own; texts under any other file go to the library as a whole.
_NORMAL = ["NFC", "Replace", "Lowercase"]
_CUT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_held: dict[str, "ChunkTokens"] = {}


class ChunkTokens:
    """Token ids of chunks between white space, as little-endian bytes, remembered within a process.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its chunks.
    A full memory of ``CACHED_CHUNKS`` chunks becomes the old one, from which chunks that are still in use
    come back, and the old one before it goes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        model = spec["model"]
        self.chunks: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.by_chunks = _cuts_by_white_space(spec)
        if not self.by_chunks:
            return
        vocab = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        letters = _byte_letters()
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[letters[b] + self.end] for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = PairMerges(
            [vocab[a] for a, _ in pairs], [vocab[b] for _, b in pairs], np.arange(len(pairs)), [vocab[a + b] for a, b in pairs]
        )

    def ids(self, texts: list[str]) -> list[bytes]:
        if not self.by_chunks:
            return [self._whole(t) for t in texts]
        # Python also splits at these four controls; the tokenizer takes them for symbols.
        odd = [any(c in t for c in "\x1c\x1d\x1e\x1f") for t in texts]
        split = [[] if o else t.split() for o, t in zip(odd, texts)]
        used = set().union(*split)
        if len(self.chunks) > CACHED_CHUNKS:
            self.old, self.chunks = self.chunks, {}
        missing = self._recalled(used.difference(self.chunks))
        if missing:
            self._learn(missing)
        get = self.chunks.__getitem__
        return [self._whole(t) if o else b"".join(map(get, words)) for o, t, words in zip(odd, texts, split)]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, missing: set[str]) -> None:
        """Remember chunks, and the lower-case words they consist of, which are chunks as well."""
        words, compound, parts = set(), [], []
        for c in missing:
            # Most chunks are one word, or one with a full stop or comma; the rest is cut by the pattern.
            if len(c) > LONGEST_CHUNK:
                self.chunks[c] = self._whole(c)
                continue
            if c.isascii() and c.isalpha():
                word = c.lower()
                words.add(word)
                if word == c:
                    continue
                part = (word,)
            elif c.isascii() and c[-1] in ".," and c[:-1].isalpha():
                part = (c[:-1].lower(), c[-1])
                words.update(part)
            elif _PLAIN(c) and "<|" not in c:  # special tokens start so, and only the library knows them
                part = _WORDS(c.lower())
                words.update(part)
            else:
                self.chunks[c] = self._whole(c)
                continue
            compound.append(c)
            parts.append(part)
        words = self._recalled(words.difference(self.chunks))
        new = list(words)
        for at, letters in by_length([w.encode() for w in new]):
            ids = np.concatenate([self.inner[letters[:, :-1]], self.last[letters[:, -1:]]], axis=1)
            for rows, final in self.merges.merge(ids):
                size = 4 * final.shape[1]
                raw = final.astype("<u4").tobytes()
                self.chunks.update(zip([new[i] for i in at[rows].tolist()], [raw[k : k + size] for k in range(0, len(raw), size)]))
        get = self.chunks.__getitem__
        self.chunks.update([(c, get(p[0]) if len(p) == 1 else b"".join(map(get, p))) for c, p in zip(compound, parts)])

    def _recalled(self, missing: set[str]) -> set[str]:
        """Bring back what the old memory has; the rest is returned."""
        if self.old:
            back = missing.intersection(self.old)
            self.chunks.update(zip(back, map(self.old.__getitem__, back)))
            missing.difference_update(back)
        return missing


def _cuts_by_white_space(spec: dict) -> bool:
    """Whether a file lower-cases, drops white space, cuts words by the known pattern and merges their bytes in order."""
    normal, cut, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec["model"]
    steps, cuts = normal.get("normalizers") or [], cut.get("pretokenizers") or []
    return (
        [x["type"] for x in steps] == _NORMAL and steps[1]["pattern"] == {"Regex": "\\s+"} and steps[1]["content"] == " "
        and [x["type"] for x in cuts] == ["Split", "ByteLevel"] and cuts[0]["pattern"] == {"Regex": _CUT}
        and (cuts[0]["behavior"], cuts[0]["invert"]) == ("Removed", True) and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
        and model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        and not any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or "<|" not in t["content"] for t in spec.get("added_tokens") or [])
    )


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def chunk_tokens(path: str) -> ChunkTokens:
    if path not in _held:
        _held[path] = ChunkTokens(path)
    return _held[path]


def _tokenised(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = chunk_tokens(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                texts = [t or "" for t in part.column(1).to_pylist()]
                rows, piece, start, length, crc, ids = [], [], [], [], [], []
                # Millions of small objects live through a batch, none in a cycle: collecting them is wasted time.
                collecting = gc.isenabled()
                gc.disable()
                try:
                    coded = tokens.ids(texts)
                finally:
                    if collecting:
                        gc.enable()
                for row, raw in enumerate(coded):
                    raw += end
                    for k in range(0, len(raw), 4 * capacity):
                        one = raw[k : k + 4 * capacity]
                        rows.append(row)
                        piece.append(k // (4 * capacity))
                        start.append(k // 4)
                        length.append(len(one) // 4)
                        crc.append(zlib.crc32(one))
                        ids.append(np.frombuffer(one, "<u4").astype(np.int32) if with_ids else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                    ],
                    names=["id", "piece", "start", "length", "ids_crc32", "ids"],
                )

    return run


def token_pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every text; a null text is empty and has the end id alone."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long, ids array<int>"
    return source.mapInArrow(_tokenised(tokenizer, capacity, end_id, with_ids), schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: sequence and offset of every length, and the fill of every sequence.

    Open sequences are stacked by free room; a bit mask of the rooms in use gives the tightest that fits.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, mask = 0, 0
    fill: list[int] = []
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        fitting = mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = stacks[room].pop()
            if not stacks[room]:
                mask ^= 1 << room
        else:
            room, at = capacity, used
            used += 1
            fill.append(0)
        bins[i], offsets[i] = at, capacity - room
        fill[at] += size
        room -= size
        if room:
            stacks[room].append(at)
            mask |= 1 << room
    return bins, offsets, np.array(fill, np.int64)


def sequence_bound(histogram: np.ndarray, capacity: int) -> int:
    """Least number of sequences by dual-feasible functions.

    ``histogram[x]`` counts the pieces of length x. Two families are tried: rounding down to multiples of
    1 / k, and counting large pieces as a whole sequence while small ones are left out.
    """
    x = np.arange(capacity + 1)
    best = -(-int((histogram * x).sum()) // capacity)
    for k in range(1, 41):
        scaled = (k + 1) * x
        value = np.where(scaled % capacity == 0, x * k, scaled // capacity * capacity)
        best = max(best, -(-int((histogram * value).sum()) // (k * capacity)))
    count, weight = np.cumsum(histogram), np.cumsum(histogram * x)
    for least in range(0, capacity // 2 + 1):
        top = capacity - least
        large = int(count[-1] - count[top])
        middle = int(weight[top] - (weight[least - 1] if least else 0))
        best = max(best, large - (-middle // capacity))
    return best


def _pack_partition(capacity: int, round_number: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not tables:
            return
        rows = pa.concat_tables(tables).combine_chunks().sort_by([("id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = rows["length"].to_numpy()
        bins, offsets, fill = best_fit(lengths, capacity)
        bound = sequence_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        base = (round_number << 56) + (TaskContext.get().partitionId() << 28)
        n = len(lengths)
        for name, values in (
            ("sequence_id", pa.array(bins + base)), ("offset", pa.array(offsets)), ("fill", pa.array(fill[bins])),
            ("certified", pa.array(np.full(n, len(fill) == bound))),
        ):
            rows = rows.append_column(name, values)
        yield from rows.to_batches(max_chunksize=10_000)

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, per_partition: int = PIECES_PER_PARTITION, rounds: int = ROUNDS) -> DataFrame:
    """Place pieces (see ``token_pieces``) in sequences: adds ``sequence_id``, ``offset``, ``fill``, ``certified``.

    ``certified`` tells that the partition that packed the piece met its own lower bound.
    """
    columns = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    schema += ", sequence_id long, offset long, fill long, certified boolean"
    lengths = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    histogram = np.zeros(capacity + 1, np.int64)
    for row in lengths:
        histogram[row["length"]] = row["count"]
    bound = sequence_bound(histogram, capacity)
    pool, amount, settled, total = pieces, int(histogram.sum()), [], 0
    before = None
    for number in range(rounds):
        parts = partitions_for(amount, per_partition)
        placed = materialise(pool.select(*columns).repartition(parts).mapInArrow(_pack_partition(capacity, number), schema), "packed")
        gaps = F.col("fill") < capacity
        seen = placed.agg(
            F.count_if(F.col("offset") == 0).alias("all"), F.count_if(gaps & (F.col("offset") == 0)).alias("gaps"), F.count_if(gaps).alias("rows")
        ).first()
        if before is not None and seen["all"] >= before[1]:
            settled.append(before[0])
            break
        total += seen["all"] - seen["gaps"]
        if parts == 1 or total + seen["gaps"] <= bound or number == rounds - 1:
            settled.append(placed)
            break
        settled.append(placed.where(~gaps))
        before = (placed.where(gaps), seen["gaps"])
        pool, amount = before[0], seen["rows"]
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    end_id: int = END_ID, with_ids: bool = True, per_partition: int = PIECES_PER_PARTITION,
) -> DataFrame:
    """Token pieces of all rows placed in sequences; every row is packed, repeated ones again.

    Returns the id column, ``piece``, ``start``, ``length``, ``ids_crc32``, ``ids`` (null unless
    ``with_ids``), ``sequence_id``, ``offset``, ``fill`` and ``certified``. Other columns are ignored. An
    empty table gives no row.
    """
    pieces = materialise(token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids), "pieces")
    return pack(pieces, capacity, per_partition).withColumnRenamed("id", id_col)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4,096 tokens."""
    ship(spark)
    packed = pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_tokenizer(), with_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
