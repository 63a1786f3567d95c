"""Hits of a lexicon of many words and phrases, for batches and streams alike.

A text is cut into pieces: words, and single characters between them. An entry is a sequence of pieces. The
lexicon becomes hash tables, put together by Spark and kept in the plan as constants: the entries of one piece, the first
pieces of longer entries, and the longer entries. A message asks for each of its pieces and compares what it
finds as text, so entries that share a hash are never confused. Nothing is shuffled, and a stream needs no state.
The tables are as large as the lexicon, so its size has to be checked before: see ``MAX_CHARS``.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.classic.column import Column as ClassicColumn

from ..functions.folding import fold
from ..functions.lexicon import WORD_CHAR

#: Characters of a lexicon that a plan may carry: some millions of words.
MAX_CHARS = 64_000_000
#: A word, or one character that belongs to no word.
PIECE = rf"{WORD_CHAR}+|[^\p{{L}}\p{{N}}_]"
_IS_WORD = rf"^{WORD_CHAR}"
#: Stands around keys.
_KEY_END = "\x01"
#: Slots in a part of a table, as a power of two.
_PART_BITS = 10

#: Columns with these names are added for a while.
PIECES, FOLDED, PRESENT, SEEN, FOUND, HITS = (
    f"_lookup_{name}" for name in ("pieces", "folded", "present", "seen", "found", "hits")
)


class Table:
    """A set of texts as slots, each one string of the keys whose hash leads there; an array of arrays of slots."""

    def __init__(self, keys: DataFrame, count: int):
        self.slots = 1 << max(4, count.bit_length() - 1)
        placed = keys.select(self._slot(F.col("key")).alias("slot"), _closed(F.col("key")).alias("key"))
        # Every slot has a place, so a slot's number is its place.
        every = keys.sparkSession.range(self.slots).select(F.col("id").cast("int").alias("slot"), F.lit("").alias("key"))
        slots = placed.union(every).groupBy("slot").agg(F.array_join(F.sort_array(F.collect_list("key")), "").alias("keys"))
        # Many tasks put parts together, so that the one that puts these in a row has few.
        parts = slots.groupBy(F.shiftright("slot", _PART_BITS).alias("part")).agg(F.sort_array(F.collect_list(F.struct("slot", "keys"))).alias("all"))
        ordered = parts.agg(F.sort_array(F.collect_list(F.struct("part", F.col("all.keys").alias("keys")))).alias("all"))
        # One row of bounded size.
        self.constant = _constant(ordered.select(F.col("all.keys")))

    def holds(self, key: Column, is_piece: bool = False) -> Column:
        # Of pieces only the control characters themselves need to be escaped.
        closed = F.when(key <= _KEY_END, _closed(key)).otherwise(_ends(key)) if is_piece else _closed(key)
        slot = self._slot(key)
        return F.contains(F.get(F.get(self.constant, F.shiftright(slot, _PART_BITS)), slot.bitwiseAND((1 << _PART_BITS) - 1)), closed)

    def _slot(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.slots)).cast("int")


class Tables:
    """The hash tables of a lexicon (the column ``word``)."""

    def __init__(self, lexicon: DataFrame):
        entries = lexicon.where(F.col("word") != "").select(fold(F.col("word")).alias("key")).distinct()
        cut = entries.select("key", _pieces(F.col("key")).alias("pieces"))
        named = cut.select("key", F.get("pieces", F.lit(0)).alias("first"), F.size("pieces").alias("n"))
        counts = named.groupBy("n").agg(F.count("*"), F.count_if(~_is_word(F.col("first"))))
        counted = sorted(tuple(row) for row in counts.collect())
        #: Numbers of pieces of the entries of several pieces.
        self.lengths = [n for n, _, _ in counted if n > 1]
        #: Whether every entry starts with a word, so that only words need to be looked up.
        self.start_with_words = not any(other for _, _, other in counted)
        ones, more = sum(k for n, k, _ in counted if n == 1), sum(k for n, k, _ in counted if n > 1)
        self.count = ones + more
        self.words = Table(named.where("n = 1").select("key"), ones)
        if self.lengths:
            several = named.where("n > 1")
            self.firsts = Table(several.select(F.col("first").alias("key")).distinct(), more)
            self.phrases = Table(several.select("key"), more)


def _constant(row: DataFrame) -> Column:
    """The one value of ``row``, an array, as a constant that keeps the bytes in which Spark has it.

    A literal made of text would be written out wherever a plan is shown or logged, and every string of the array
    would be an object of its own, in the driver and in each task.
    """
    query = row._jdf.queryExecution()
    value = query.executedPlan().executeCollect()[0].getArray(0)
    java = row.sparkSession._jvm.org.apache.spark.sql
    literal = java.catalyst.expressions.Literal(value, query.analyzed().schema().apply(0).dataType())
    return ClassicColumn(java.classic.ExpressionUtils.column(literal))


def _closed(key: Column) -> Column:
    """``key`` between ends that it cannot contain."""
    for plain, escaped in (("\x00", "\x00a"), (_KEY_END, "\x00b")):
        key = F.replace(key, F.lit(plain), F.lit(escaped))
    return _ends(key)


def _ends(key: Column) -> Column:
    return F.concat(F.lit(_KEY_END), key, F.lit(_KEY_END))


def with_hits(messages: DataFrame, tables: Tables, text: str = "text") -> DataFrame:
    """Adds the pieces of each text, and its hits as (at, n): leftmost first, the longest at each place, no overlap."""
    folded = fold(F.col(text))
    asked = F.regexp_extract_all(folded, F.lit(f"{WORD_CHAR}+"), F.lit(0)) if tables.start_with_words else _pieces(folded)
    # Each different piece is looked up once; most texts have none that an entry starts with, and cost no more.
    # The tables stand in the plan at this one place each: 1 if a piece is an entry, and 2 more if longer ones start with it.
    named = F.transform(
        F.array_distinct(asked), lambda piece: F.struct(piece.alias("piece"), _first(tables, piece).alias("kinds"))
    )
    known = messages.select("*", F.filter(named, lambda item: item["kinds"] > 0).alias(PRESENT))
    some = F.size(PRESENT) > 0
    cut = known.select("*", F.when(some, _pieces(folded)).alias(FOLDED), F.when(some, _pieces(F.col(text))).alias(PIECES))
    seen = F.transform(
        FOLDED,
        lambda piece: F.coalesce(F.get(F.filter(PRESENT, lambda item: item["piece"] == piece), F.lit(0))["kinds"], F.lit(0)),
    )
    asked = cut.select("*", seen.alias(SEEN))
    found = F.filter(
        F.transform(SEEN, lambda kinds, at: F.struct(at.alias("at"), _longest(tables, kinds, at).alias("n"))),
        lambda hit: hit["n"] > 0,
    )
    # Exploding a one-element array keeps a filter on hits above the search. As a plain projection the steps before would be
    # put into the filter, and all of them done again for each piece.
    marked = asked.select("*", F.explode(F.array(F.when(some, found))).alias(FOUND))
    hits = _without_overlaps(tables.lengths[-1]) if tables.lengths else F.col(FOUND)
    return marked.select("*", hits.alias(HITS))


def is_hit() -> Column:
    """Whether a text of :func:`with_hits` has a hit."""
    return F.coalesce(F.size(FOUND) > 0, F.lit(False))


def replaced(text: Column, mask: Column | None) -> Column:
    """``text`` with its hits replaced by ``mask``, or by an asterisk for each of their characters."""

    def start(at: Column) -> Column:
        before = F.get(HITS, at - 1)
        return F.when(at > 0, before["at"] + before["n"]).otherwise(0)

    def joined(first: Column, n: Column) -> Column:
        return F.array_join(F.slice(PIECES, first + 1, n), "")

    def part(hit: Column, at: Column) -> Column:
        gap = joined(start(at), hit["at"] - start(at))
        hidden = F.repeat(F.lit("*"), F.char_length(joined(hit["at"], hit["n"]))) if mask is None else mask
        return F.concat(gap, hidden)

    end = start(F.size(HITS))
    rebuilt = F.concat(F.array_join(F.transform(HITS, part), ""), joined(end, F.size(PIECES) - end))
    return F.when(F.coalesce(F.size(HITS) > 0, F.lit(False)), rebuilt).otherwise(text)


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))


def _is_word(piece: Column) -> Column:
    return F.coalesce(piece.rlike(_IS_WORD), F.lit(False))


def _first(tables: Tables, piece: Column) -> Column:
    kinds = tables.words.holds(piece, is_piece=True).cast("int")
    return kinds + 2 * tables.firsts.holds(piece, is_piece=True).cast("int") if tables.lengths else kinds


def _longest(tables: Tables, kinds: Column, at: Column) -> Column:
    """Pieces of the longest entry at ``at``; 0 without one."""

    def stands(n: Column) -> Column:
        first, last = F.get(FOLDED, at), F.get(FOLDED, at + n - 1)
        # A piece that is a word has no word character beside it; any other must not touch one.
        free_before = _is_word(first) | ~_is_word(F.get(FOLDED, at - 1))
        free_after = _is_word(last) | ~_is_word(F.get(FOLDED, at + n))
        return last.isNotNull() & free_before & free_after

    one = F.when(((kinds == 1) | (kinds == 3)) & stands(F.lit(1)), 1).otherwise(0)
    if not tables.lengths:
        return F.when(kinds > 0, one).otherwise(0)
    fits = F.filter(
        F.array(*map(F.lit, tables.lengths)),
        lambda n: stands(n) & tables.phrases.holds(F.array_join(F.slice(FOLDED, at + 1, n), "")),
    )
    several = F.when(kinds >= 2, F.coalesce(F.array_max(fits), one)).otherwise(one)
    return F.when(kinds > 0, several).otherwise(0)


def _without_overlaps(longest: int) -> Column:
    """The hits that are left when each one found is taken unless the one taken before it reaches into it."""

    def free(hit: Column, at: Column) -> Column:
        # A hit that reaches here starts fewer than ``longest`` pieces before, and so is among as many found.
        before = F.slice(FOUND, F.greatest(at - longest + 2, F.lit(1)), F.least(at, F.lit(longest - 1)))
        return ~F.exists(before, lambda other: other["at"] + other["n"] > hit["at"])

    # Only hits between two free ones depend on each other.
    numbered = F.transform(FOUND, lambda hit, at: F.when(free(hit, at), at))
    starts = F.filter(numbered, lambda at: at.isNotNull())
    ends = F.concat(F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.size(FOUND)))
    groups = F.zip_with(starts, ends, lambda a, b: F.slice(FOUND, a + 1, b - a))
    none = F.array().cast("array<struct<at:int,n:int>>")

    def take(state: Column, hit: Column) -> Column:
        taken = F.struct((hit["at"] + hit["n"]).alias("end"), F.concat(state["kept"], F.array(hit)).alias("kept"))
        return F.when(hit["at"] >= state["end"], taken).otherwise(state)

    def resolved(group: Column) -> Column:
        state = F.struct(F.lit(0).alias("end"), none.alias("kept"))
        return F.when(F.size(group) < 2, group).otherwise(F.aggregate(group, state, take, lambda s: s["kept"]))

    return F.flatten(F.transform(groups, resolved))
