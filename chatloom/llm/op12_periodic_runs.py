"""Periodic runs of words, found with a suffix automaton and link-cut access.

The words of a stretch of text are appended to a suffix automaton. Then the prefixes are visited in order:
the path of suffix links from a prefix to the root is recoloured with the prefix's end, and each segment
of it that had one colour so far tells where the longest of its strings ended last. If that end is not
further away than the string is long, both occurrences touch: a square, whose period is the distance and
whose left end cannot be moved. Moved to the right as far as its period holds, it is a run. The links form a
forest of preferred paths held in splay trees (the access of a link-cut tree), so n words take
O(n log^2 n) steps.

A run of at least 24 words and three periods consists of 8-word strings that occur again within it: for
each of its words, one such string lies a period before or after another. So only stretches covered by 8-word strings that
occur twice in their text are given to the automaton. All others have no run, whatever their content.

Nulls and ties: a null text has no words; a null id stays null; rows that repeat are each answered. Extra
columns are ignored, whatever their names. An empty table gives no rows. A text of any length is taken whole:
a task holds about 1 kB for each word of the longest stretch that repeats itself.
"""

from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import mix64, table, text_chunks

#: Shortest run in words, and in periods.
MIN_WORDS, MIN_PERIODS = 24, 3
#: Words of the strings that must occur twice. Every run is covered while 2 * GRAM <= MIN_WORDS - GRAM.
GRAM = 8

WORD = r"([^\x20\x09-\x0D]+)"

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class SuffixAutomaton:
    """States, their longest lengths and suffix links after all words were appended."""

    def __init__(self, words: list[int]):
        steps, link, longest, prefixes, last = [{}], [-1], [0], [], 0
        for word in words:
            state = len(link)
            steps.append({})
            longest.append(longest[last] + 1)
            link.append(0)
            at = last
            while at != -1 and word not in steps[at]:
                steps[at][word] = state
                at = link[at]
            if at != -1:
                to = steps[at][word]
                if longest[to] != longest[at] + 1:
                    copy = len(link)
                    steps.append(dict(steps[to]))
                    longest.append(longest[at] + 1)
                    link.append(link[to])
                    link[to] = copy
                    while at != -1 and steps[at].get(word) == to:
                        steps[at][word] = copy
                        at = link[at]
                    to = copy
                link[state] = to
            prefixes.append(state)
            last = state
        self.link, self.longest, self.prefixes = link, longest, prefixes


class ColouredPaths:
    """A rooted forest cut into paths of one colour each. The colour is kept at the root of a path's splay tree."""

    def __init__(self, parents: list[int]):
        n = len(parents)
        # The automaton's first state stands for the empty string and is left out.
        self.up = [parent if parent > 0 else -1 for parent in parents]
        self.shallow, self.deep, self.colour = [-1] * n, [-1] * n, [-1] * n

    def recolour(self, node: int, colour: int):
        """Gives the path from ``node`` to its root a colour; yields (deepest node, former colour) of each segment."""
        up, deep, colours = self.up, self.deep, self.colour
        at, below = node, -1
        while at != -1:
            self._splay(at)
            former = colours[at]
            if former >= 0:
                yield at, former
            cut = deep[at]
            if cut != -1:
                colours[cut] = former
            deep[at] = below
            below, at = at, up[at]
        self._splay(node)
        colours[node] = colour

    def _splay(self, x: int) -> None:
        """Makes ``x`` the root of its splay tree, which keeps its colour."""
        up, shallow, deep, colours = self.up, self.shallow, self.deep, self.colour
        while True:
            p = up[x]
            if p == -1 or (shallow[p] != x and deep[p] != x):
                return
            g = up[p]
            if g == -1 or (shallow[g] != p and deep[g] != p):
                colours[x] = colours[p]
                self._rotate(x, p, g)
                return
            root = up[g]
            if root == -1 or (shallow[root] != g and deep[root] != g):
                colours[x] = colours[g]
            if (shallow[p] == x) == (shallow[g] == p):
                self._rotate(p, g, root)
                self._rotate(x, p, root)
            else:
                self._rotate(x, p, g)
                self._rotate(x, g, root)

    def _rotate(self, x: int, p: int, g: int) -> None:
        up, shallow, deep = self.up, self.shallow, self.deep
        if shallow[p] == x:
            inner = shallow[p] = deep[x]
            deep[x] = p
        else:
            inner = deep[p] = shallow[x]
            shallow[x] = p
        if inner != -1:
            up[inner] = p
        if g != -1:
            if shallow[g] == p:
                shallow[g] = x
            elif deep[g] == p:
                deep[g] = x
        up[x], up[p] = g, x


def squares(words: np.ndarray):
    """(end, period, length of the string that occurs twice) of squares, one of each run of three periods at least."""
    automaton = SuffixAutomaton(words.tolist())
    paths, longest = ColouredPaths(automaton.link), automaton.longest
    for end, state in enumerate(automaton.prefixes):
        for node, former in paths.recolour(state, end):
            if end - former <= longest[node]:
                yield end, end - former, longest[node]


def _period_ends(words: np.ndarray, at: int, period: int) -> int:
    """The first place from ``at`` on whose word differs from that a period before."""
    width = 16
    while at < len(words):
        differ = words[at : at + width] != words[at - period : at - period + len(words[at : at + width])]
        if differ.any():
            return at + int(differ.argmax())
        at, width = at + width, 2 * width
    return len(words)


def stretch_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs among ``words``, with the smallest period of each."""
    reach, found = {}, {}
    for end, period, length in squares(words):
        if reach.get(period, -1) >= end:
            continue  # part of a run that is known
        start = end - length - period + 1
        stop = _period_ends(words, end + 1, period)
        reach[period] = stop - 1
        if stop - start >= max(MIN_WORDS, MIN_PERIODS * period):
            # A multiple of the smallest period spans the same words.
            key = (start, stop - start)
            found[key] = min(period, found.get(key, period))
    return [(start, length, period) for (start, length), period in found.items()]


def repeating_stretches(words: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the stretches covered by strings of ``GRAM`` words that occur twice."""
    if len(words) < MIN_WORDS:
        return []
    grams = np.zeros(len(words) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        # Strings that share a hash by chance only make a stretch longer.
        grams = mix64(grams * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(grams)].astype(np.uint64))
    order = np.argsort(grams)
    equal = grams[order[1:]] == grams[order[:-1]]
    if not equal.any():
        return []
    twice = np.zeros(len(grams), bool)
    twice[order[1:][equal]] = twice[order[:-1][equal]] = True
    change = np.zeros(len(words) + 1, np.int64)
    change[:-GRAM] += twice
    change[GRAM:] -= twice
    covered = np.zeros(len(words) + 2, bool)
    covered[1:-1] = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(covered[1:] != covered[:-1])
    return [(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) if b - a >= MIN_WORDS]


def text_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a text, by start and period."""
    ids: dict[bytes, int] = {}
    number = count()
    coded = np.fromiter((ids[w] if w in ids else ids.setdefault(w, next(number)) for w in words), np.int64, len(words))
    return sorted(
        ((a + start, length, period) for a, b in repeating_stretches(coded) for start, length, period in stretch_runs(coded[a:b])),
        key=lambda run: (run[0], run[2]),
    )


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by a space."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_words, runs (start, length, period; by start and period) and the collapsed text of each row."""
    id_field = docs.select(id_col).schema[0]

    def scan(batches):
        for batch in text_chunks(batches, "text"):
            n_words, runs, collapsed = [], [], []
            for text in batch.column("text"):
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                found = text_runs(words)
                n_words.append(len(words))
                runs.append([{"start": s, "length": m, "period": p} for s, m, p in found])
                collapsed.append(without_repeats(words, found))
            kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(runs, kind),
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ],
                names=["id", "n_words", "runs", "collapsed"],
            )

    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = named.mapInArrow(scan, f"id {id_field.dataType.simpleString()}, n_words bigint, runs {RUNS}, collapsed string")
    return found.withColumnRenamed("id", id_col)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the ids, by their hash, get words that repeat from some word on. Without an id a text stays."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    hashed = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).cast("bigint").alias("g"))
    # Only planted texts are cut into words here.
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(1)))
    cut = hashed.select("doc_id", "text", "g", words.alias("words"))
    sized = cut.select("doc_id", "text", "g", "words", F.size("words").cast("bigint").alias("n"))
    first = sized.select("*", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int").alias("a"))
    period = (F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8))).cast("int")
    ready = first.select("*", period.alias("p"), (F.col("n") - F.col("a")).cast("int").alias("rest"))
    times = F.ceil(F.col("rest") / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times)), F.lit(1), F.col("rest"))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return ready.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def _better(a: Column, b: Column) -> Column:
    """Whether run ``a`` has the greater exact exponent; of equal ones the earlier start, then the smaller period."""
    left, right = a["length"] * b["period"], b["length"] * a["period"]
    earlier = (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"]))
    return (left > right) | ((left == right) & earlier)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its runs as digests, the run with the greatest exponent, and the digest of the collapsed words."""
    found = find_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)), lambda kept, run: F.when(_better(run, kept), run).otherwise(kept))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    ranked = found.select("*", best.alias("best"), listed.alias("listed"))
    return ranked.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col("best")[name].alias(name) for name in ("start", "length", "period")],
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
