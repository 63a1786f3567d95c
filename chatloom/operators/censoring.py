"""Masking profanity, and dropping messages that contain it.

The work is one expression per row, without a shuffle and the same on a stream: a pattern up to
``MAX_PATTERN_CHARS`` of lexicon, hash tables in the plan (:mod:`.lookup`) up to ``MAX_CHARS``. Beyond that, words
of a batch are joined with the lexicon, since a plan should not carry it.
"""

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.folding import fold
from ..functions.lexicon import (
    MAX_PATTERN_CHARS,
    WORD_CHAR,
    gap_pattern,
    is_plain_word,
    mask_literal,
    word_pattern,
)
from ..functions.skew import PIECE, copy_keys, cut_rows, hot_keys
from ..session import materialize
from . import lookup

Lexicon = DataFrame | Iterable[str | None]

LENGTH_MASK = "length"

# So many words that messages share with a large lexicon may stand in the plan.
MAX_LISTED = 5000


def censor_messages(
    messages: DataFrame,
    lexicon: Lexicon,
    mask: str = "***",
    max_pattern_chars: int = MAX_PATTERN_CHARS,
    max_table_chars: int = lookup.MAX_CHARS,
) -> DataFrame:
    """``messages`` with every whole-word hit in ``text`` replaced.

    ``mask="length"`` puts one asterisk per character; any other mask is used as it is. ``lexicon``
    is a list of words or phrases, or a frame with the column ``word``.
    """
    words, frame = _sized(messages, lexicon, max_pattern_chars)
    if frame is None:
        pattern = word_pattern(words)
        return messages if pattern is None else _mask_column(messages, pattern, mask)
    if _fits_tables(messages, frame, max_table_chars):
        hits = lookup.with_hits(messages, lookup.Tables(frame))
        hidden = None if mask == LENGTH_MASK else F.lit(mask)
        return hits.withColumn("text", lookup.replaced(F.col("text"), hidden)).select(*messages.columns)
    words, phrases, present = _occurring(messages, frame, max_pattern_chars)
    if present is None:
        return censor_messages(messages, words + phrases, mask, 2 * max_pattern_chars)
    if phrases:
        if _contains_word(mask):
            raise ValueError("with this many words and phrases the mask must have no word in it")
        messages = _mask_column(messages, word_pattern(phrases), mask)
    pieces = F.regexp_extract_all("text", F.lit(rf"{WORD_CHAR}+|[^\p{{L}}\p{{N}}_]+"), F.lit(0))
    masked = F.transform(
        pieces,
        lambda piece: F.when(
            F.array_contains("_hits", fold(piece)),
            F.repeat(F.lit("*"), F.char_length(piece)) if mask == LENGTH_MASK else F.lit(mask),
        ).otherwise(piece),
    )
    text = F.when(F.col("_hits").isNotNull(), F.array_join(masked, "")).otherwise(F.col("text"))
    if present.listed is None:
        return _with_hits(messages, present).withColumn("text", text).select(*messages.columns)
    # Only messages with a hit are shuffled.
    hit = _has_listed(present.listed)
    masked = _with_hits(messages.where(hit), present).withColumn("text", text).select(*messages.columns)
    return messages.where(~hit).unionByName(masked)


def drop_profane_messages(
    messages: DataFrame,
    lexicon: Lexicon,
    max_pattern_chars: int = MAX_PATTERN_CHARS,
    max_table_chars: int = lookup.MAX_CHARS,
) -> DataFrame:
    """The messages without a hit. A null text has no hit, so its message is kept."""
    words, frame = _sized(messages, lexicon, max_pattern_chars)
    if frame is None:
        return _without_matches(messages, word_pattern(words))
    if _fits_tables(messages, frame, max_table_chars):
        hits = lookup.with_hits(messages, lookup.Tables(frame))
        return hits.where(~lookup.is_hit()).select(*messages.columns)
    words, phrases, present = _occurring(messages, frame, max_pattern_chars)
    if present is None:
        return drop_profane_messages(messages, words + phrases, 2 * max_pattern_chars)
    messages = _without_matches(messages, word_pattern(phrases))
    if present.listed is not None:
        return messages.where(~_has_listed(present.listed))
    hit = F.arrays_overlap("_hits", _all_words(fold(F.col("text"))))
    kept = _with_hits(messages, present).where(~F.coalesce(hit, F.lit(False)))
    return kept.select(*messages.columns)


def censored(text: Column, pattern: str, mask: str) -> Column:
    """``text`` with the matches of ``pattern`` masked."""
    if mask != LENGTH_MASK:
        return F.regexp_replace(text, F.lit(pattern), F.lit(mask_literal(mask)))
    # The pieces between hits are joined again with asterisks. Only messages with a hit pay for
    # that; the others cost one search, whatever the number of word lengths.
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # A split would compile the pattern anew for every row; a search compiles it once.
    gaps = F.regexp_extract_all(text, F.lit(gap_pattern(pattern)), F.lit(1))
    pieces = F.slice(gaps, F.lit(1), F.size(hits) + 1)
    stars = F.transform(hits, lambda hit: F.repeat(F.lit("*"), F.char_length(hit)))
    rebuilt = F.zip_with(
        pieces, F.concat(stars, F.array(F.lit(""))), lambda piece, star: F.concat(piece, star)
    )
    return F.when(text.rlike(pattern), F.array_join(rebuilt, "")).otherwise(text)


def _mask_column(messages: DataFrame, pattern: str, mask: str) -> DataFrame:
    return messages.withColumn("text", censored(F.col("text"), pattern, mask))


def _without_matches(messages: DataFrame, pattern: str | None) -> DataFrame:
    if pattern is None:
        return messages
    return messages.where(~F.coalesce(F.col("text").rlike(pattern), F.lit(False)))


def _contains_word(mask: str) -> bool:
    return mask != LENGTH_MASK and any(is_plain_word(char) for char in mask)


def _sized(
    messages: DataFrame, lexicon: Lexicon, max_chars: int
) -> tuple[list[str], None] | tuple[None, DataFrame]:
    """The lexicon as a list if its size allows a pattern, else as a frame."""
    if isinstance(lexicon, DataFrame):
        words = _collect_bounded(lexicon, max_chars)
        return (None, lexicon) if words is None else (words, None)
    words = [word for word in lexicon if word]
    if sum(map(len, words)) <= max_chars:
        return words, None
    return None, messages.sparkSession.createDataFrame([(word,) for word in words], "word string")


def _fits_tables(messages: DataFrame, lexicon: DataFrame, max_chars: int) -> bool:
    """Whether the plan may carry the lexicon. On a stream, whose rows cannot be joined and put together again, always."""
    if messages.isStreaming:
        return True
    return (lexicon.agg(F.sum(F.char_length("word"))).first()[0] or 0) <= max_chars


def _collect_bounded(lexicon: DataFrame, max_chars: int) -> list[str] | None:
    """The words of a frame, or None without collecting if they have too many characters."""
    size = lexicon.agg(F.sum(F.char_length("word")).alias("chars")).first()["chars"]
    if (size or 0) > max_chars:
        return None
    return [row["word"] for row in lexicon.where(F.col("word") != "").collect()]


class _Present(NamedTuple):
    """Words of a large lexicon that the messages use."""

    words: DataFrame
    # Any hot words of the messages, and those of them that are not in the lexicon.
    hot: DataFrame
    hot_elsewhere: DataFrame
    # The words themselves, if they are few.
    listed: list[str] | None


def _occurring(
    messages: DataFrame, lexicon: DataFrame, max_chars: int
) -> tuple[list[str] | None, list[str], _Present | None]:
    """What a large lexicon comes down to: a list of the used words or, if that is too long, a
    frame of them; and its phrases."""
    word = fold(F.col("word"))
    # Stored, so that the test for plain words is not inferred for the words of the messages too.
    folded = materialize(
        lexicon.where(word != "")
        .select(word.alias("word"), word.rlike(f"^{WORD_CHAR}+$").alias("is_plain"))
        .distinct(),
        "lexicon",
    )
    phrases = _collect_bounded(folded.where("not is_plain"), max_chars)
    if phrases is None:
        raise ValueError(f"more than {max_chars} characters of phrases in the lexicon")
    # One row per word on both sides, combined in each task first: no key is hot.
    used = materialize(_words(messages).groupBy("word").agg(F.count(F.lit(1)).alias("n")), "words")
    plain = folded.where("is_plain").select("word")
    present = materialize(plain.join(used, "word", "left_semi"), "lexicon-used")
    words = _collect_bounded(present, max_chars)
    if words is not None:
        return words, phrases, None
    hot = hot_keys(used, "word")
    hot_elsewhere = hot.join(present, "word", "left_anti").select("word")
    listed = [row["word"] for row in present.limit(MAX_LISTED + 1).collect()]
    return None, phrases, _Present(present, hot, hot_elsewhere, listed if len(listed) <= MAX_LISTED else None)


def _all_words(text: str | Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"{WORD_CHAR}+"), F.lit(0))


def _has_listed(words: list[str]) -> Column:
    found = F.exists(_all_words(fold(F.col("text"))), lambda word: word.isin(words))
    return F.coalesce(found, F.lit(False))


def _words(messages: DataFrame) -> DataFrame:
    """(key, word): the distinct folded words of each text."""
    # The key is taken first, so that neither the text nor its hash is repeated for every word.
    folded = messages.select(_key(), fold(F.col("text")).alias("folded"))
    return folded.select("_key", F.explode(F.array_distinct(_all_words("folded"))).alias("word"))


def _key() -> Column:
    # Two texts with one key would share their hits. That is harmless: all of them are words of the
    # lexicon, and each text is only searched for the words it has.
    return F.xxhash64("message_id", "text").alias("_key")


def _with_hits(messages: DataFrame, present: _Present) -> DataFrame:
    """``messages`` plus ``_hits``, the words of each text that are present, null if none."""
    # The most frequent words are usually harmless: those are dropped before the shuffle.
    words = _words(messages)
    if present.listed is not None:
        words = words.where(F.col("word").isin(present.listed))
    words = words.join(F.broadcast(present.hot_elsewhere), "word", "left_anti")
    pieces = cut_rows(words, "word", present.hot, F.col("_key"))
    hits = (
        pieces.join(copy_keys(present.words, "word", present.hot), ["word", PIECE])
        .groupBy("_key")
        .agg(F.collect_set("word").alias("_hits"))
    )
    return messages.select("*", _key()).join(hits, "_key", "left")
