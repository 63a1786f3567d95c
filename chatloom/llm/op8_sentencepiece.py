"""SentencePiece encoding and decoding with a public piece vocabulary.

Texts are cut into words (a run of spaces and what follows it), each distinct word of a batch is
encoded once, words of equal length advance together in numpy (``lattice``): hashes of all substrings
that end at a position probe the sorted piece keys, the maximum over the pieces that fit is stored with
a pointer back. The vocabulary is of the merging kind (BPE), so a piece's score says whether it is the
last merge result of the prefix, instead of adding log-probabilities: only this gives the ids of the
public library. Characters without a piece fall back to their UTF-8 bytes.

Defined results: null text has no ids (null), empty text has an empty list. Repeated rows and ties of
ids are separate rows, each encoded. Columns other than the id and the text are ignored by the query;
``encode`` and ``decode`` keep them, and replace a column that has the name of their output. U+2581
in a text stands for a space, as in the library, so it decodes to a space.
"""

import functools

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.llm.common import ragged, table, text_chunks
from chatloom.llm.lattice import Lattice, merge_word

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Words that a worker remembers, and the characters in them: they bound its memory.
MEMO = 250_000
MEMO_CHARS = 4 << 20
#: Bytes of text whose new words are encoded together, and bytes of text that is cut into words, gets its ids and is
#: decoded at once. The second takes about 50 bytes of memory for each, the first only if all words are new.
ENCODE_BYTES = 4 << 20
SPELLED_BYTES = 512 << 10
#: Characters of new words that are encoded at once.
WORD_CHARS = 1 << 19


class Pieces:
    """A piece model's vocabulary as a lattice, and the bytes that each id decodes to."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.byte_ids = np.zeros(256, np.int32)
        self.unk_id = model.unk_id()
        self.unk_text = model.decode([self.unk_id]).encode()
        plain, texts = [], []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                texts.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unused(i):
                texts.append(b"")
            elif model.is_unknown(i):
                texts.append(self.unk_text)
            else:
                plain.append((-model.get_score(i), i, tuple(map(ord, piece))))
                texts.append(piece.replace(SPACE, " ").encode())
        self.has_bytes = bool(self.byte_ids.any())
        rank = {symbols: score for score, _, symbols in plain}
        joined = lambda a, b: rank.get(a + b)
        # Pieces that merging never reaches are no tokens of the lattice.
        split = {}
        for _, _, symbols in plain:
            if len(symbols) > 1:
                split[symbols] = self._last_merge(symbols, joined)
        kept = [p for p in plain if len(p[2]) == 1] + sorted(
            p for p in plain if len(p[2]) > 1 and split[p[2]] is not None
        )
        tokens = [p[2] for p in kept]
        at = {symbols: k for k, symbols in enumerate(tokens)}
        halves = [(k, k) if len(s) == 1 else [at[h] for h in split[s]] for k, s in enumerate(tokens)]
        pairs = [
            (at[s[:c]], at[s[c:]], k)
            for k, s in enumerate(tokens)
            for c in range(1, len(s))
            if s[:c] in at and s[c:] in at
        ]
        # Pieces given to the model by hand, such as its runs of spaces, share one score.
        ranks = np.unique([p[0] for p in kept], return_inverse=True)[1]
        self.lattice = Lattice(tokens, np.array(pairs), np.array(halves), np.array([p[1] for p in kept]), ranks)
        # Where no piece holds two symbols side by side, long words can be cut.
        inside = {a << 32 | b for s in tokens for a, b in zip(s, s[1:])}
        self.inside = np.array(sorted(inside), np.uint64)
        self._forget()
        self.text_data = np.frombuffer(b"".join(texts), np.uint8)
        self.text_offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))

    @staticmethod
    def _last_merge(symbols, joined):
        """The two pieces that merging joins last to make all of ``symbols``; None if it does not."""
        seen = []

        def ranked(a, b):
            rank = joined(a, b)
            if rank is not None and len(a) + len(b) == len(symbols):
                seen.append((a, b))
            return rank

        return seen[-1] if len(merge_word(symbols, ranked)) == 1 else None

    def _forget(self):
        self.memo, self.chars, self.new = {}, 0, []
        self.ids, self.spans = np.zeros(0, np.int32), np.zeros((2, 0), np.int64)

    def make_room(self):
        """Forgets all words if there are too many, or some that were looked up but not learned."""
        if self.new or len(self.memo) > MEMO or self.chars > MEMO_CHARS:
            self._forget()

    def slots(self, words: list[str]) -> np.ndarray:
        """The number of each of these distinct words in memory; ``learn`` has to follow."""
        known = len(self.memo)
        slots = np.fromiter((self.memo.setdefault(w, len(self.memo)) for w in words), np.int64, len(words))
        self.new += [words[k] for k in np.flatnonzero(slots >= known).tolist()]
        return slots

    def learn(self) -> tuple[np.ndarray, np.ndarray]:
        """Encodes the words that are new: ids of all words in memory, and where each word's begin and how many it has."""
        ends = np.cumsum([len(w) for w in self.new])
        at = 0
        ids, spans, base = [self.ids], [self.spans], len(self.ids)
        while at < len(self.new):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + WORD_CHARS, "right")))
            found, offsets = self.words(self.new[at:to])
            ids.append(found)
            spans.append(np.stack([offsets[:-1] + base, np.diff(offsets)]))
            base, at = base + len(found), to
        self.chars += int(ends[-1]) if len(ends) else 0
        self.ids, self.spans, self.new = np.concatenate(ids), np.concatenate(spans, axis=1), []
        return self.ids, self.spans

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word (spaces as U+2581) and their offsets."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        symbols = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        ends = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
        cuts = ends
        if len(symbols) > 1:
            codes = symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:].astype(np.uint64)
            at = np.minimum(np.searchsorted(self.inside, codes), len(self.inside) - 1)
            apart = np.flatnonzero(self.inside[at] != codes) + 1
            cuts = np.union1d(ends, apart)
        tokens, offsets = self.lattice.encode(symbols, cuts)
        ids = np.where(tokens >= 0, self.lattice.ids[tokens], -1).astype(np.int32)
        if (tokens < 0).any():
            ids, offsets = self._fallback(symbols, cuts, ids, offsets)
        return ids, offsets[np.searchsorted(cuts, ends)]

    def _fallback(self, symbols, cuts, ids, offsets):
        """Puts the bytes of each unknown symbol in its place. Unknown symbols are words of one."""
        owner = np.repeat(np.arange(len(cuts) - 1), np.diff(offsets))
        lost = np.flatnonzero(ids < 0)
        extra = [list(chr(symbols[cuts[owner[k]]]).encode("utf-8", "surrogatepass")) for k in lost]
        sizes = np.ones(len(ids), np.int64)
        if not self.has_bytes:
            ids[lost] = self.unk_id
            return ids, offsets
        sizes[lost] = [len(x) for x in extra]
        out = np.repeat(ids, sizes)
        place = np.cumsum(sizes) - sizes
        out[ragged(place[lost], sizes[lost])] = self.byte_ids[np.concatenate([np.array(x) for x in extra])]
        return out, np.concatenate(([0], np.cumsum(sizes)))[offsets]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each text and their offsets; null counts as empty."""
        self.make_room()
        found = self.look_up(column)
        return self.spell(self.learn(), *found)

    def look_up(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number in memory of each word of the texts, and the offsets of the texts among these words."""
        texts = pc.replace_substring(pc.fill_null(column.cast(pa.large_string()), ""), SPACE, " ")
        split = pc.split_pattern(texts, " ")
        tokens, bounds = split.values, split.offsets.to_numpy()
        tokens, bounds = tokens.slice(bounds[0], bounds[-1] - bounds[0]), bounds - bounds[0]
        coded = tokens.dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        empty = pc.binary_length(tokens).to_numpy(zero_copy_only=False) == 0
        row = np.repeat(np.arange(len(column)), np.diff(bounds))
        # Every token has a space before it (the first: the one that the library adds). Empty tokens
        # are further spaces of the next word, or at a row's end words of spaces only.
        ends_row = np.zeros(len(index), bool)
        ends_row[bounds[1:] - 1] = True
        blank_text = np.zeros(len(index), bool)
        only = np.flatnonzero(np.diff(bounds) == 1)
        blank_text[bounds[only]] = empty[bounds[only]]
        word = (~empty | ends_row) & ~blank_text
        at = np.flatnonzero(word)
        before = np.concatenate(([-1], at[:-1]))
        start = np.maximum(before + 1, bounds[row[at]])
        spaces = at - start + 1
        names = coded.dictionary.to_pylist()
        widths, width = np.unique(spaces, return_inverse=True)
        unique, back = np.unique(index[at] * len(widths) + width, return_inverse=True)
        words = [SPACE * int(widths[c % len(widths)]) + names[c // len(widths)] for c in unique.tolist()]
        per_row = np.bincount(row[at], minlength=len(column))
        return self.slots(words)[back].astype(np.int32), np.concatenate(([0], np.cumsum(per_row)))

    @staticmethod
    def spell(learned: tuple[np.ndarray, np.ndarray], slots: np.ndarray, bounds: np.ndarray):
        """Ids of each text and their offsets, from what ``learn`` and ``look_up`` returned."""
        ids, (begin, size) = learned
        counts = size[slots]
        return ids[ragged(begin[slots], counts)], np.concatenate(([0], np.cumsum(counts)))[bounds]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The text of each run of ids. Bytes that are no UTF-8 become U+FFFD."""
        sizes = np.diff(self.text_offsets)[ids]
        data = self.text_data[ragged(self.text_offsets[:-1][ids], sizes)]
        ends = np.concatenate(([0], np.cumsum(sizes)))[offsets]
        # The space that encoding put in front goes.
        filled = np.flatnonzero(np.diff(ends))
        lead = np.zeros(len(ends) - 1, np.int64)
        lead[filled] = data[ends[:-1][filled]] == 32
        starts = ends[:-1] + lead
        sizes = ends[1:] - starts
        data, ends = data[ragged(starts, sizes)], np.concatenate(([0], np.cumsum(sizes)))
        raw = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())]
        )
        try:
            return raw.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.string())


@functools.lru_cache(4)
def pieces(path: str) -> Pieces:
    """Built once in each Python worker."""
    return Pieces(path)


def model_path(name: str = MODEL) -> str:
    return public_tokenizers.path(name)


def _spelled(vocabulary: Pieces, batches, text_col: str):
    """``batches`` in pieces, each with the ids of its texts and their offsets."""
    for part in text_chunks(batches, text_col, ENCODE_BYTES):
        vocabulary.make_room()
        pieces = list(text_chunks([part], text_col, SPELLED_BYTES))
        found = [vocabulary.look_up(piece.column(text_col)) for piece in pieces]
        learned = vocabulary.learn()
        for piece, (slots, bounds) in zip(pieces, found):
            yield piece, *vocabulary.spell(learned, slots, bounds)


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array, names: list[str]):
    held = dict(zip(batch.schema.names, batch.columns)) | {name: values}
    return pa.RecordBatch.from_arrays([held[n] for n in names], names=names)


def _schema(frame: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    kept = [f for f in frame.schema.fields if f.name != name]
    return T.StructType([*kept, T.StructField(name, kind)])


def encode(docs: DataFrame, text_col: str = "text", to: str = "token_ids", model: str | None = None) -> DataFrame:
    """``docs`` with the piece ids of ``text_col``. ``model``: a path that every executor has."""
    schema, model = _schema(docs, to, T.ArrayType(T.IntegerType())), model or model_path()
    names = schema.names

    def work(batches):
        vocabulary = pieces(model)
        for part, ids, offsets in _spelled(vocabulary, batches, text_col):
            column = part.column(text_col)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            if column.null_count:
                lists = pc.if_else(column.is_valid(), lists, pa.nulls(len(lists), lists.type))
            yield _with_column(part, to, lists, names)

    return docs.mapInArrow(work, schema)


def decode(docs: DataFrame, ids_col: str = "token_ids", to: str = "decoded", model: str | None = None) -> DataFrame:
    """``docs`` with the text that ``ids_col`` stands for; null for null."""
    schema, model = _schema(docs, to, T.StringType()), model or model_path()
    names = schema.names

    def work(batches):
        vocabulary = pieces(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                column = part.column(ids_col)
                lists = pc.fill_null(column, pa.scalar([], column.type)) if column.null_count else column
                sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                texts = vocabulary.decode(flat, np.concatenate(([0], np.cumsum(sizes))))
                if column.null_count:
                    texts = pc.if_else(column.is_valid(), texts, pa.nulls(len(texts), pa.string()))
                yield _with_column(part, to, texts, names)

    return docs.mapInArrow(work, schema)


def encode_and_check(docs: DataFrame, text_col: str = "text", to: str = "token_ids", flag: str = "round_trip", model: str | None = None) -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``docs`` with the ids, and whether they decode to the text (with
    spaces for U+2581; true for null)."""
    schema, model = _schema(_flagged(docs, flag), to, T.ArrayType(T.IntegerType())), model or model_path()
    names = schema.names

    def work(batches):
        vocabulary = pieces(model)
        for part, ids, offsets in _spelled(vocabulary, batches, text_col):
            column = part.column(text_col)
            texts = pc.replace_substring(pc.fill_null(column, ""), SPACE, " ")
            same = pc.equal(vocabulary.decode(ids, offsets), texts)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            if column.null_count:
                lists = pc.if_else(column.is_valid(), lists, pa.nulls(len(lists), lists.type))
            part = _with_column(part, to, lists, [n for n in names if n != flag])
            yield _with_column(part, flag, same, names)

    return docs.mapInArrow(work, schema)


def _flagged(docs: DataFrame, flag: str) -> DataFrame:
    return docs.drop(flag).withColumn(flag, F.lit(True))


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_tokens", F.coalesce(F.size("token_ids"), F.lit(0)).cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its ids, their number, and whether decoding gives the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _counted(encode_and_check(docs)).select("doc_id", "n_tokens", "token_ids", "round_trip")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: ``docs`` with their ids, the number of ids, and whether decoding gives the text."""
    return _counted(encode_and_check(docs))
