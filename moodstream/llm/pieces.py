"""SentencePiece encoding and decoding by batched Viterbi.

Texts are cut before every run of word marks, which no piece crosses, and different words of a batch are
encoded once. Words of equal length advance together: at each end position, substring hashes probe the sorted
piece hashes, and the best score over all start positions becomes the backpointer.

A model file of the merging kind stores ranks, not log-probabilities. Viterbi reads them as scores, exactly as
the library does once the file is declared a unigram model; ``encode_merges`` gives the ids of the file's own
kind by the same lockstep over equal-length words.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.llm.common import ship
from moodstream.llm.lockstep import PairMerges

MARK = "▁"
CACHED_WORDS = 200_000
_SLICE_CHARS = 2_000_000
#: Words of more letters are encoded one by one, in time that grows in proportion to their length.
LONGEST_WORD = 1_000
_BUCKET_BITS, _LED_BITS = 20, 22
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_FACTOR = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNKNOWN_PENALTY = 10.0
_held: dict[str, "PieceModel"] = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread hashes evenly: those of short pieces are small numbers."""
    with np.errstate(over="ignore"):
        return (x ^ (x >> np.uint64(29))) * _FACTOR


class PieceModel:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        if len(model.normalizer_spec.precompiled_charsmap):
            raise ValueError("models with a character map are not supported")
        if model.normalizer_spec.remove_extra_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models that drop or move white space are not supported")
        self.prefix = model.normalizer_spec.add_dummy_prefix
        self.pieces = [p.piece for p in model.pieces]
        self.kinds = np.array([p.type for p in model.pieces])
        self.scores = np.array([p.score for p in model.pieces], np.float32)
        if (self.kinds == _USER).any():
            raise ValueError("models with user-defined pieces are not supported")
        self.unknown = int(np.flatnonzero(self.kinds == _UNKNOWN)[0])
        self.bytes = {int(self.pieces[i][3:5], 16): int(i) for i in np.flatnonzero(self.kinds == _BYTE)}
        normal = np.flatnonzero(self.kinds == _NORMAL)
        crossing = re.compile(f"[^{MARK}]{MARK}")
        self.split = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall if not any(crossing.search(self.pieces[i]) for i in normal) else lambda t: [t]
        self.longest = max((len(self.pieces[i]) for i in normal), default=1)
        self.lowest = float(self.scores[normal].min()) if len(normal) else 0.0
        hashes = _mixed(np.array([self._hash_one(self.pieces[i]) for i in normal], np.uint64))
        by = np.argsort(hashes)
        self.keys, self.ids = hashes[by], normal[by].astype(np.int64)
        # The leading bits of a hash lead to the few sorted keys that share them.
        leading = (self.keys >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
        self.first = np.searchsorted(leading, np.arange(1 << _BUCKET_BITS)).astype(np.int32)
        self.depth = int(np.bincount(leading).max()) if len(leading) else 1
        self.led = np.zeros(1 << _LED_BITS, bool)
        self.led[(self.keys >> np.uint64(64 - _LED_BITS)).astype(np.int64)] = True
        self.keys = np.append(self.keys, np.zeros(self.depth + 1, np.uint64))
        self.ids = np.append(self.ids, np.zeros(self.depth + 1, np.int64))
        self.letters = np.full((len(self.pieces), self.longest), -1, np.int64)
        for i in normal:
            self.letters[i, : len(self.pieces[i])] = [ord(c) for c in self.pieces[i]]
        self.sizes = np.array([len(p) for p in self.pieces])
        self.id_of = {self.pieces[i]: int(i) for i in normal}
        values = {i: bytes([b]) for b, i in self.bytes.items()}
        silent = {int(i): b"" for i in np.flatnonzero((self.kinds == _CONTROL) | (self.kinds == _UNUSED))}
        special = values | silent | {self.unknown: " ⁇ ".encode()}
        self.written = [special[i] if i in special else p.encode() for i, p in enumerate(self.pieces)]
        self._merges: PairMerges | None = None
        # Words met so far by method, and the memory before that, which is given up when a new one is full.
        self.words: dict[str, bytes] = {}
        self.merged: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.old_merged: dict[str, bytes] = {}

    @staticmethod
    def _hash_one(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_FACTOR) + ord(c) + 1) % 2**64
        return h

    def normal(self, text: str) -> str:
        text = text.replace(" ", MARK)
        return MARK + text if self.prefix and text else text

    def viterbi(self, letters: np.ndarray) -> list[bytes]:
        """Best ids (little-endian, 32 bits) of equally long words, given as a matrix of code points."""
        n, size = letters.shape
        if size > LONGEST_WORD:
            return [self._viterbi_one(row) for row in letters]
        best = np.full((n, size + 1), -np.inf, np.float32)
        best[:, 0] = 0
        back = np.zeros((n, size + 1), np.int32)
        piece = np.full((n, size + 1), self.unknown, np.int64)
        codes = letters.astype(np.uint64) + np.uint64(1)
        raw = np.zeros((n, 0), np.uint64)
        line = np.arange(n)
        for end in range(1, size + 1):
            longest = min(end, self.longest)
            # Hashes of all substrings that end here, shortest first: those that ended one letter before, and this letter.
            longer = np.empty((n, longest), np.uint64)
            longer[:, 0] = codes[:, end - 1]
            if longest > 1:
                with np.errstate(over="ignore"):
                    np.multiply(raw[:, : longest - 1], _FACTOR, out=longer[:, 1:])
                    longer[:, 1:] += codes[:, end - 1 : end]
            raw = longer
            ending = _mixed(raw)
            # Few substrings share their leading bits with a piece; only these are looked up.
            row, back_by = np.nonzero(self.led[(ending >> np.uint64(64 - _LED_BITS)).astype(np.int64)])
            wanted = ending[row, back_by]
            start = self.first[(wanted >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)]
            at = np.full(len(row), -1, np.int32)
            for step in range(self.depth):
                at = np.where(self.keys[start + step] == wanted, start + step, at)
            hit = np.flatnonzero(at >= 0)
            row, back_by, found = row[hit], back_by[hit], self.ids[at[hit]]
            # The longest substring stands first, so on ties the longest piece wins.
            score, ids = np.full((n, longest), -np.inf, np.float32), np.full((n, longest), -1, np.int32)
            score[row, longest - 1 - back_by] = best[row, end - 1 - back_by] + self.scores[found]
            ids[row, longest - 1 - back_by] = found
            alone = ids[:, -1] < 0
            score[alone, -1] = best[alone, end - 1] + np.float32(self.lowest - _UNKNOWN_PENALTY)
            ids[alone, -1] = self.unknown
            take = score.argmax(axis=1)
            best[:, end], back[:, end], piece[:, end] = score[line, take], longest - take, ids[line, take]
        return self._paths(letters, back, piece)

    def _viterbi_one(self, letters: np.ndarray) -> bytes:
        """The same for one long word, with its substrings looked up as text."""
        word = letters.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        size, longest, ids = len(word), self.longest, self.id_of.get
        scores, strange = self.scores, np.float32(self.lowest - _UNKNOWN_PENALTY)
        best = [np.float32(0)] + [np.float32(-np.inf)] * size
        back, piece = np.zeros(size + 1, np.int32), np.full(size + 1, self.unknown, np.int64)
        for end in range(1, size + 1):
            top, length, taken = np.float32(-np.inf), 1, self.unknown
            # The longest first: a shorter piece must be better to win.
            for k in range(min(end, longest), 0, -1):
                found = ids(word[end - k : end])
                if found is not None:
                    score = best[end - k] + scores[found]
                elif k == 1:
                    score, found = best[end - 1] + strange, self.unknown
                else:
                    continue
                if score > top:
                    top, length, taken = score, k, found
            best[end], back[end], piece[end] = top, length, taken
        return self._path(letters, back, piece).astype("<i4").tobytes()

    def _paths(self, letters: np.ndarray, back: np.ndarray, piece: np.ndarray) -> list[bytes]:
        """Follow the backpointers of all words together; words with unknown letters are finished one by one.

        A hash may hit a piece of other letters. The pieces of a path are compared with the word, and a word where one
        differs is encoded by look-ups of its text. A false hit beside the path has lost to it and changes nothing.
        """
        n, size = letters.shape
        out = np.zeros((n, size), np.int32)
        at, line = np.full(n, size), np.arange(n)
        filled = np.full(n, size)
        strange, wrong = np.zeros(n, bool), np.zeros(n, bool)
        place = np.arange(min(size, self.longest))
        for slot in range(size - 1, -1, -1):
            rows = line[at > 0]
            if not len(rows):
                break
            end = at[rows]
            taken, length = piece[rows, end], back[rows, end]
            unknown = taken == self.unknown
            strange[rows] |= unknown
            spelt = letters[rows[:, None], np.minimum((end - length)[:, None] + place, size - 1)]
            same = ((spelt == self.letters[taken, : len(place)]) | (place >= length[:, None])).all(axis=1)
            wrong[rows] |= ~(unknown | same & (self.sizes[taken] == length))
            out[rows, slot] = taken
            filled[rows] = slot
            at[rows] -= length
        raw, width = out.astype("<i4").tobytes(), 4 * size
        paths = [raw[i * width + 4 * f : (i + 1) * width] for i, f in enumerate(filled.tolist())]
        for i in np.flatnonzero(strange & ~wrong).tolist():
            paths[i] = self._path(letters[i], back[i], piece[i]).astype("<i4").tobytes()
        for i in np.flatnonzero(wrong).tolist():
            paths[i] = self._viterbi_one(letters[i])
        return paths

    def _path(self, letters: np.ndarray, back: np.ndarray, piece: np.ndarray) -> np.ndarray:
        out: list[int] = []
        end = len(letters)
        while end:
            if piece[end] == self.unknown:
                out += self._fallback(int(letters[end - 1]))[::-1]
            else:
                out.append(int(piece[end]))
            end -= int(back[end])
        return np.array(out[::-1], np.int64)

    def _fallback(self, code: int) -> list[int]:
        return [self.bytes[b] for b in chr(code).encode("utf-8", "surrogatepass")] if self.bytes else [self.unknown]

    def merges(self) -> PairMerges:
        """Pairs whose join is a piece, the better score first; single letters outside the pieces get numbers past them."""
        if self._merges is None:
            number = dict(self.id_of)
            left, right, rank, merged = [], [], [], []
            order = np.argsort(np.argsort(-self.scores[: len(self.pieces)], kind="stable"), kind="stable")
            for text, i in self.id_of.items():
                for cut in range(1, len(text)):
                    a, b = text[:cut], text[cut:]
                    if (len(a) == 1 or a in self.id_of) and (len(b) == 1 or b in self.id_of):
                        left.append(number.setdefault(a, len(self.pieces) + 0x200000 + ord(a[0]) if len(a) == 1 else -1))
                        right.append(number.setdefault(b, len(self.pieces) + 0x200000 + ord(b[0]) if len(b) == 1 else -1))
                        rank.append(int(order[i]))
                        merged.append(i)
            self._merges = PairMerges(left, right, rank, merged)
        return self._merges

    def merge(self, letters: np.ndarray) -> list[bytes]:
        """Ids of equally long words by merging the best pair first."""
        codes, at = np.unique(letters, return_inverse=True)
        beyond = len(self.pieces) + 0x200000
        ids = np.array([self.id_of.get(chr(c), beyond + int(c)) for c in codes.tolist()], np.int64)[at.reshape(letters.shape)]
        out: list[bytes] = [b""] * len(letters)
        merges = self.merges()
        alone = [(np.array([i]), merges.merge_one(row)[None, :]) for i, row in enumerate(ids)] if ids.shape[1] > LONGEST_WORD else merges.merge(ids)
        for rows, final in alone:
            raw, width = final.astype("<i4").tobytes(), 4 * final.shape[1]
            for k, i in enumerate(rows.tolist()):
                out[i] = raw[k * width : (k + 1) * width]
            for k in np.flatnonzero((final >= beyond).any(axis=1)).tolist():
                word = [x for v in final[k].tolist() for x in (self._fallback(v - beyond) if v >= beyond else [v])]
                out[int(rows[k])] = np.array(word, "<i4").tobytes()
        return out

    def _known(self, words: set[str], held: dict[str, bytes], old: dict[str, bytes], method: Callable) -> Callable[[str], bytes]:
        """Look-up of words by a method, after the missing ones were recalled or encoded."""
        missing = words.difference(held)
        back = missing.intersection(old)
        held.update(zip(back, map(old.__getitem__, back)))
        todo = sorted(missing.difference(back), key=len)
        start = 0
        while start < len(todo):
            size = len(todo[start])
            end = start
            while end < len(todo) and len(todo[end]) == size and (end - start) * size < 200_000:
                end += 1
            some = todo[start:end]
            letters = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64).reshape(-1, size)
            held.update(zip(some, method(letters)))
            start = end
        return held.__getitem__

    def encode_both(self, texts: list[str], methods: tuple[str, ...] = ("viterbi", "merges")) -> list[list[np.ndarray]]:
        """Ids of all texts by each method."""
        split = [self.split(self.normal(t)) for t in texts]
        words = set().union(*split)
        if max(len(self.words), len(self.merged)) > CACHED_WORDS:
            self.old_words, self.old_merged, self.words, self.merged = self.words, self.merged, {}, {}
        out = []
        for name in methods:
            if name == "viterbi":
                get = self._known(words, self.words, self.old_words, self.viterbi)
            else:
                get = self._known(words, self.merged, self.old_merged, self.merge)
            out.append([np.frombuffer(b"".join(map(get, w)), "<i4") for w in split])
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.encode_both(texts, ("viterbi",))[0]

    def encode_merges(self, texts: list[str]) -> list[np.ndarray]:
        return self.encode_both(texts, ("merges",))[0]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; bytes that are not UTF-8 become replacement characters, control ids nothing."""
        raw = b"".join(map(self.written.__getitem__, np.asarray(ids).tolist()))
        text = raw.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


def piece_model(path: str) -> PieceModel:
    if path not in _held:
        _held[path] = PieceModel(path)
    return _held[path]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``_SLICE_CHARS``: the more words advance together, the less a step costs each."""
    sizes = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(sizes):
        before = int(sizes[first - 1]) if first else 0
        end = max(first + 1, int(np.searchsorted(sizes, before + _SLICE_CHARS, "right")))
        yield first, end
        first = end


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            for first, end in _slices(batch.column(1)):
                part = batch.slice(first, end - first)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids, merged = model.encode_both(texts)
                back = [model.decode(x) == t.replace(MARK, " ") for x, t in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(merged, pa.list_(pa.int32())), pa.array(back)],
                    names=["row", "ids", "merge_ids", "round_trip"],
                )

    return run


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every text: the id column, ``ids`` (Viterbi), ``merge_ids`` (pair merging) and ``round_trip``.

    Null and empty texts have no ids. ``round_trip`` tells that decoding ``ids`` gives the text again, a word mark
    in the text counting as a space. Repeated rows are encoded again; other columns are ignored.
    """
    source = docs.select(F.col(id_col).alias("row"), F.col(text_col).alias("text"))
    kind = source.schema["row"].dataType.simpleString()
    out = source.mapInArrow(_encoded(model), f"row {kind}, ids array<int>, merge_ids array<int>, round_trip boolean")
    return out.withColumnRenamed("row", id_col)


def decode_pieces(encoded: DataFrame, model: str, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns in ``keep`` and ``text`` decoded from ids; null ids give a null text."""
    source = encoded.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col(ids_col).alias("ids"))

    def run(batches):
        decode = piece_model(model).decode
        for batch in batches:
            texts = [None if x is None else decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    out = source.mapInArrow(run, f"row {source.schema['row'].dataType.simpleString()}, text string")
    return out.select(*[F.col("row").getField(c).alias(c) for c in keep], "text")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crc = []
        for k in (1, 2):
            values, borders = batch.column(k).values.to_numpy().astype("<u4", copy=False), batch.column(k).offsets.to_numpy()
            crc.append([zlib.crc32(values[a:b]) for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())])
        sizes = [pc.list_value_length(batch.column(k)).cast(pa.int64()) for k in (1, 2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), sizes[0], pa.array(crc[0], pa.int64()), sizes[1], pa.array(crc[1], pa.int64()), batch.column(3)],
            names=["doc_id", "n_ids", "ids_crc32", "n_merge_ids", "merge_ids_crc32", "round_trip"],
        )


def op2(spark, sf_dir: str) -> DataFrame:
    """Ids of all documents as checksums, and whether decoding gives the text again."""
    ship(spark)
    encoded = encode_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_model())
    return encoded.mapInArrow(_digest, "doc_id long, n_ids long, ids_crc32 long, n_merge_ids long, merge_ids_crc32 long, round_trip boolean")
