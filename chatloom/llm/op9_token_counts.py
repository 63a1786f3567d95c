"""Token counts by a tokenizer compiled to finite-state transducers.

Two deterministic machines replace the tokenizer. The first reads character classes and marks where its
splitting pattern starts a new word: texts are cut into chunks, each chunk is turned into a map from
every entry state to its exit state, the maps are composed by a parallel prefix scan, and then every
chunk knows its entry state and marks its words. The second reads the bytes of a word; its state after
a prefix is the prefix's last token, and each transition carries the number of tokens so far
(``lattice``). Distinct words of a batch are run once.

The classes look two characters ahead, so that the first machine needs no delayed output: a white-space
character knows whether it ends its run before other text, an apostrophe whether a contraction follows.

Defined results: null counts as empty, 0 bytes and 0 tokens. A special token's string inside a text is
one token, as is the library's default. Repeated ids are separate rows. Columns other than the id and
the text are ignored by the query; ``count_tokens`` keeps them and replaces columns with its names.
"""

import functools
import json

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from chatloom.llm.common import flat_bytes, sums, table, text_chunks
from chatloom.llm.lattice import Lattice

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
MEMO = 600_000
#: Characters of a chunk whose state map is made at once.
CHUNK = 256

# Symbols of the splitting machine; + FIRST: at a text's start.
LETTER, NUMBER, OTHER, SHORT, LONG, BLANK, LAST, LAST_SPACE = range(8)
FIRST, INNER, SPECIAL = 8, 16, 17
# Its states. GLUE: a space that belongs to what follows; ONE, TWO: so many letters of a contraction left.
START, IN_L, IN_N, IN_O, IN_W, GLUE, ONE, TWO = range(8)


def splitting_machine() -> tuple[np.ndarray, np.ndarray]:
    """The next state and whether a word starts, by symbol and state."""
    to, cut = np.zeros((18, 8), np.int8), np.ones((18, 8), bool)
    runs = {LETTER: IN_L, NUMBER: IN_N, OTHER: IN_O}
    for state in range(8):
        for symbol in range(8):
            if state in (ONE, TWO):
                to[symbol, state], cut[symbol, state] = (START if state == ONE else ONE), False
            elif symbol in (SHORT, LONG):
                inside = state in (IN_O, GLUE)
                to[symbol, state] = IN_O if inside else (ONE if symbol == SHORT else TWO)
                cut[symbol, state] = not inside
            elif symbol in runs:
                to[symbol, state] = runs[symbol]
                cut[symbol, state] = state not in (runs[symbol], GLUE)
            else:
                to[symbol, state] = {BLANK: IN_W, LAST: START, LAST_SPACE: GLUE}[symbol]
                cut[symbol, state] = not (symbol == BLANK and state == IN_W)
    to[FIRST : FIRST + 8] = to[:8, START, None]
    to[INNER:] = START
    cut[INNER] = False
    return to, cut


@functools.cache
def classes() -> np.ndarray:
    """Class of each code point: LETTER, NUMBER, BLANK or OTHER."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", BLANK)):
        for found in regex.finditer(pattern, every):
            out[np.frombuffer(found[0].encode("utf-32-le"), np.uint32)] = kind
    return out


def scan(symbols: np.ndarray, to: np.ndarray) -> np.ndarray:
    """The state before each symbol, from START, by composing the state maps of chunks."""
    n = len(symbols)
    m = -(-n // CHUNK)
    grid = np.full(m * CHUNK, INNER, np.uint8)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(m, CHUNK).T).astype(np.int16) * 8
    flat = to.ravel().astype(np.int16)
    maps = np.tile(np.arange(8, dtype=np.int16), (m, 1))
    for row in grid:
        maps = flat[row[:, None] + maps]
    # Inclusive scan: after step k a map covers its chunk and the 2^k - 1 before it.
    step = 1
    while step < m:
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].astype(np.int64), axis=1)
        step *= 2
    state = np.zeros(m, np.int16)
    state[1:] = maps[:-1, START]
    states = np.empty(grid.shape, np.int8)
    for k, row in enumerate(grid):
        states[k] = state
        state = flat[row + state]
    return states.T.reshape(-1)[:n]


class TokenMachine:
    """Both machines of one byte-level merge vocabulary (a ``tokenizers`` file)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        # The public byte-to-character table: printable characters stand for themselves.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
        tokens = [(b,) for b in range(256)]
        at = {t: k for k, t in enumerate(tokens)}
        pairs, halves = [], [(k, k) for k in range(256)]
        for merge in merges:
            left, right = (tuple(byte[c] for c in x) for x in (merge if isinstance(merge, list) else merge.split(" ")))
            pairs.append((at[left], at[right], len(tokens)))
            halves.append((at[left], at[right]))
            at[left + right] = len(tokens)
            tokens.append(left + right)
        names = {tuple(byte[c] for c in name): i for name, i in vocabulary.items() if all(c in byte for c in name)}
        self.lattice = Lattice(tokens, np.array(pairs), np.array(halves), np.array([names[t] for t in tokens]))
        self.to, self.cut = splitting_machine()
        self.memo: dict[bytes, int] = {}

    def symbols(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol of each character and the byte it starts at."""
        raw = data.tobytes()
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        begin = np.flatnonzero((data & 0xC0) != 0x80)
        kind = classes()[points]
        n = len(points)
        first = np.zeros(n + 1, bool)
        first[np.searchsorted(begin, offsets)] = True
        special = np.zeros(n, np.uint8)
        for text in self.special:
            at = raw.find(text)
            while at >= 0:
                lo, hi = np.searchsorted(begin, (at, at + len(text)))
                # A match may not reach over the end of a text.
                if not first[lo + 1 : hi].any():
                    special[lo], special[lo + 1 : hi] = SPECIAL, INNER
                    first[lo] = first[hi] = True
                at = raw.find(text, at + len(text))
        after = ~first[1:]
        blank = kind == BLANK
        follows = np.zeros(n, bool)
        follows[:-1] = after[:-1] & ~blank[1:]
        out = kind.copy()
        ends = blank & follows
        out[ends] = LAST
        out[ends & (points == 32)] = LAST_SPACE
        quote = np.flatnonzero((points == 39) & after)
        one = points[np.minimum(quote + 1, n - 1)]
        two = np.where(quote + 2 < n, points[np.minimum(quote + 2, n - 1)], 0)
        two = np.where(after[np.minimum(quote + 1, n - 1)], two, 0)
        out[quote[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
        pairs = one.astype(np.uint64) << np.uint64(32) | two
        out[quote[np.isin(pairs, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])]] = LONG
        out[first[:-1]] += FIRST
        return np.where(special > 0, special, out), begin

    def counts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and tokens of each text."""
        data, offsets = flat_bytes(column)
        if not len(data):
            zero = np.zeros(len(column), np.int64)
            return zero, zero
        symbols, begin = self.symbols(data, offsets)
        starts = begin[self.cut[symbols, scan(symbols, self.to)]]
        bounds = np.append(starts, len(data))
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)]
        ).dictionary_encode()
        each = self.word_counts(words.dictionary)[words.indices.to_numpy(zero_copy_only=False)]
        return np.diff(offsets), sums(each, np.searchsorted(starts, offsets))

    def word_counts(self, words: pa.Array) -> np.ndarray:
        names = words.to_pylist()
        out = np.fromiter((self.memo.get(w, -1) for w in names), np.int64, len(names))
        new = np.flatnonzero(out < 0)
        data, offsets = flat_bytes(words.take(pa.array(new)))
        out[new] = np.diff(self.lattice.encode(data, offsets, counts_only=True)[1])
        for k in new[np.isin(np.diff(offsets), [len(s) for s in self.special])]:
            # The pattern would have split it: it was found as a special token.
            if names[k] in self.special:
                out[k] = 1
        if len(self.memo) > MEMO:
            self.memo.clear()
        self.memo.update(zip([names[k] for k in new.tolist()], out[new].tolist()))
        return out


@functools.lru_cache(4)
def machine(path: str) -> TokenMachine:
    """Compiled once in each Python worker."""
    return TokenMachine(path)


def count_tokens(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``docs`` without the text, with ``n_bytes`` and ``n_tokens``. ``vocabulary``: a path that every
    executor has."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    kept = [f for f in docs.schema.fields if f.name not in (text_col, "n_bytes", "n_tokens")]
    more = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]

    def work(batches):
        compiled = machine(path)
        for part in text_chunks(batches, text_col):
            n_bytes, n_tokens = compiled.counts(part.column(text_col))
            held = dict(zip(part.schema.names, part.columns))
            yield pa.RecordBatch.from_arrays(
                [*(held[f.name] for f in kept), pa.array(n_bytes), pa.array(n_tokens)],
                names=[*(f.name for f in kept), "n_bytes", "n_tokens"],
            )

    return docs.mapInArrow(work, T.StructType([*kept, *more]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its bytes, its tokens, and whether they exceed the limit."""
    counted = count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return counted.withColumn("over_limit", counted["n_tokens"] > LIMIT)
