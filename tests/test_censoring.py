import random
import sys

import pytest
from pyspark.sql import functions as F

from chatloom.functions.lexicon import NON_ASCII_CASES, WORD_CHAR, clean_words, fold_char, mask_literal, word_pattern
from chatloom.operators import censor_messages, drop_profane_messages
from chatloom.plans.sql_tasks import run_sql_task
from helpers import find_hits, mask_text, messages, texts

WORDS = ["idiot", "дурак", "идиот"]

CASES = [
    ("idiot", "*"),
    ("Ídiot idiot", "Ídiot *"),
    ("éidiot", "éidiot"),
    ("idioté", "idioté"),
    ("дурак!", "*!"),
    ("идиот-ИДИОТ", "*-*"),
    ("idiot idiot idiot", "* * *"),
    ("idiotic", "idiotic"),
    ("idiot_1", "idiot_1"),
    ("IdIoT, ok", "*, ok"),
    (None, None),
    ("", ""),
]


PATTERN = {"max_pattern_chars": 10_000}
TABLES = {"max_pattern_chars": 0}
JOIN = {"max_pattern_chars": 0, "max_table_chars": 0}
WAYS = [PATTERN, TABLES, JOIN]


@pytest.fixture(scope="module")
def cases(spark):
    return messages(spark, [given for given, _ in CASES]).cache()


@pytest.mark.parametrize("way", WAYS)
def test_whole_words_in_any_script(cases, way):
    masked = censor_messages(cases, WORDS, mask="*", **way)
    assert texts(masked) == [want for _, want in CASES]


@pytest.mark.parametrize("way", WAYS)
def test_dropping_keeps_null_and_clean_texts(cases, way):
    kept = drop_profane_messages(cases, WORDS, **way)
    assert texts(kept) == [given for given, want in CASES if given == want]


def test_masking_is_idempotent(cases):
    once = censor_messages(cases, WORDS)
    assert texts(censor_messages(once, WORDS)) == texts(once)


def test_sql_agrees(cases):
    masked = run_sql_task("censor_messages", cases, WORDS, mask="*")
    assert texts(masked) == [want for _, want in CASES]
    kept = run_sql_task("drop_profane_messages", cases, WORDS)
    assert texts(kept) == [given for given, want in CASES if given == want]
    untouched = [given for given, _ in CASES]
    assert texts(run_sql_task("censor_messages", cases, [])) == untouched
    assert texts(run_sql_task("drop_profane_messages", cases, [])) == untouched


def test_metacharacters_are_literal(spark):
    given = messages(spark, ["a c++ b a.b axb $1", r"x \E y [z"])
    masked = censor_messages(given, ["c++", "a.b", r"\E", "[z"], mask="$\\")
    assert texts(masked) == ["a $\\ b $\\ axb $1", "x $\\ y $\\"]


def test_longest_entry_wins(spark):
    given = messages(spark, ["c c++ big bad wolf big bad", "big"])
    words = ["c", "C++", "big", "big bad"]
    assert texts(censor_messages(given, words, "length")) == ["* *** ******* wolf *******", "***"]


def test_empty_lexicon_changes_nothing(spark, cases):
    for lexicon in ([], ["", None], spark.createDataFrame([], "word string")):
        assert texts(censor_messages(cases, lexicon)) == [given for given, _ in CASES]
        assert drop_profane_messages(cases, lexicon).count() == len(CASES)


def test_lexicon_frame(spark, cases):
    lexicon = spark.createDataFrame([(word,) for word in [*WORDS, None, ""]], "word string")
    for way in (*WAYS, {"max_pattern_chars": 15, "max_table_chars": 0}):
        masked = censor_messages(cases, lexicon, mask="*", **way)
        assert texts(masked) == [want for _, want in CASES]


def test_large_lexicon_that_the_messages_hardly_use(spark, cases):
    # Too long for a pattern, but the words that occur are not.
    lexicon = [f"unused{i}" for i in range(500)] + WORDS
    masked = censor_messages(cases, lexicon, mask="*", max_pattern_chars=100, max_table_chars=0)
    assert texts(masked) == [want for _, want in CASES]


def test_large_lexicon_with_phrases(spark):
    given = ["such a big bad idiot", "Big Bad", "big", "c++ idiot ugly", None]
    words = ["idiot", "such", "ugly", "big bad", "c++"]
    frame = messages(spark, given)
    join = {"max_pattern_chars": 10, "max_table_chars": 0}
    for way in (TABLES, join):
        for mask in ("*", "length"):
            masked = censor_messages(frame, words, mask, **way)
            assert texts(masked) == [mask_text(text, words, mask) for text in given]
        assert texts(drop_profane_messages(frame, words, **way)) == ["big", None]
    assert texts(censor_messages(frame, words, "such", **TABLES)) == [mask_text(text, words, "such") for text in given]
    # Only a lexicon that no plan should carry has limits.
    with pytest.raises(ValueError, match="mask"):
        censor_messages(frame, words, "such", **join).collect()
    with pytest.raises(ValueError, match="phrases"):
        censor_messages(frame, words, **(join | {"max_pattern_chars": 5}))


def test_tables_on_random_phrases(spark):
    """Overlapping phrases, entries of signs and control characters, and masks that are entries themselves."""
    rng = random.Random(11)
    signs = ["a", "B", "c1", "é", " ", "  ", "+", "+", ".", "\x00", "\x01", "\x02", "\n", "👍"]
    words = ["".join(rng.choices(signs, k=rng.randint(1, 5))) for _ in range(60)] + ["a a", "a a a", "a a b", "\x01", "\x00a", "c1", "+"]
    given = ["".join(rng.choices(signs, k=rng.randint(0, 25))) for _ in range(1500)] + ["a " * 500, None, ""]
    frame = messages(spark, given)
    for mask in ("a", "length"):
        got = texts(censor_messages(frame, words, mask, **TABLES))
        wrong = [(t, g, w) for t, g in zip(given, got, strict=True) if g != (w := mask_text(t, words, mask))]
        assert not wrong, (mask, wrong[:5])
    clean = [text for text in given if text is None or not find_hits(text, words)]
    assert texts(drop_profane_messages(frame, words, **TABLES)) == clean


def test_same_result_with_very_many_entries(spark, cases):
    unused = spark.range(200_000).select(F.concat(F.lit("unused"), F.col("id").cast("string")).alias("word"))
    lexicon = unused.union(spark.createDataFrame([(word,) for word in WORDS], "word string"))
    masked = censor_messages(cases, lexicon, mask="*")
    assert texts(masked) == [want for _, want in CASES]
    plan = masked._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_sql_takes_any_lexicon(spark, cases, monkeypatch):
    monkeypatch.setattr("chatloom.plans.sql_tasks.MAX_PATTERN_CHARS", 0)
    assert texts(run_sql_task("censor_messages", cases, WORDS, mask="*")) == [want for _, want in CASES]
    assert texts(run_sql_task("drop_profane_messages", cases, WORDS)) == [given for given, want in CASES if given == want]


def test_messages_without_ids_or_with_repeated_ids(spark):
    rows = [(None, "idiot"), (None, "ok"), (1, "an idiot"), (1, "a scum"), (1, "an idiot")]
    frame = spark.createDataFrame(rows, "message_id bigint, text string")
    masked = censor_messages(frame, ["idiot", "scum"], "*", **JOIN)
    got = sorted(row["text"] for row in masked.collect())
    assert got == sorted(["*", "ok", "an *", "a *", "an *"])


def test_random_texts_against_brute_force(spark):
    """All ways agree with a plain search, irregular case pairs included."""
    rng = random.Random(7)
    alphabet = "iIİısSſkKKσΣςßẞµμéåÅ𐐀𐐨_1 .-+́"
    words = ["is", "kiss", "σίς", "Iσ", "ſk", "µ1", "ß", "é", "Å", "𐐨i", "i", "1"]
    given = ["".join(rng.choices(alphabet, k=rng.randint(0, 14))) for _ in range(3000)]
    given += [" ".join(rng.choices(words, k=4)) for _ in range(500)]
    assert sum(bool(find_hits(text, words)) for text in given) > 500
    frame = messages(spark, given)
    for mask in ("#", "length"):
        want = [mask_text(text, words, mask) for text in given]
        for way in WAYS:
            got = texts(censor_messages(frame, words, mask, **way))
            wrong = [(t, g, w) for t, g, w in zip(given, got, want, strict=True) if g != w]
            assert not wrong, (way, mask, wrong[:5])
    clean = [text for text in given if not find_hits(text, words)]
    for way in WAYS:
        assert texts(drop_profane_messages(frame, words, **way)) == clean


def test_pattern_factors_prefixes():
    assert clean_words(["Idiot", "idiot", "", None]) == ["idiot"]
    assert word_pattern([]) is None
    assert "s(?:cum|tupid)" in word_pattern(["scum", "stupid"])
    assert mask_literal("$\\") == "\\$\\\\"
    # A long entry does not exhaust the stack.
    assert word_pattern(["a" * 5000]) is not None


# Every character that equals an ASCII letter but for case, and what may stand before a hit.
CLOSE = ["scum", "Scum", "\u017fcum", "kit", "\u212ait", "idiot", "\u0130diot", "\u0131d\u0131ot", "a", "$x", "$X", "b c"]


@pytest.mark.parametrize("more", [[], ["a"], ["$x", "b c"], ["é"], ["-ab", "^ab", "]ab", "\\ab"]])
def test_pattern_looks_at_first_characters_first(spark, more):
    words = ["scum", "kit", "idiot", "stupid", *more]
    pattern = word_pattern(words)
    # A set without regard to flags comes first, unless a word starts beyond ASCII.
    assert pattern.startswith("[") == ("é" not in more)
    before = ["", " ", "x", "é", "_", "7", "\n", "-", "𝐚", "🎉", "e\u0301", "s", "k", "-\U00010400"]
    given = [f"{b}{w}{a}" for b in before for w in [*CLOSE, *more] for a in ("", " ", "s", "é", "\n", "𝐚", f" {w}")]
    old = rf"(?iu)(?<!{WORD_CHAR})(?:{'|'.join(sorted(map(quoted, words), key=len, reverse=True))})(?!{WORD_CHAR})"
    frame = messages(spark, given)
    found = [F.regexp_extract_all("text", F.lit(p), F.lit(0)) for p in (pattern, old)]
    rows = frame.select("text", found[0].alias("new"), found[1].alias("old")).collect()
    assert [r for r in rows if r.new != r.old] == [] and any(r.new for r in rows)


def quoted(word):
    return "".join(rf"\x{{{ord(c):x}}}" for c in word)


def test_cases_beyond_ascii_are_all_known():
    found = {}
    for char in map(chr, range(128, sys.maxunicode + 1)):
        if fold_char(char).isascii():
            found.setdefault(fold_char(char), set()).add(char)
    assert found == {letter: set(chars) for letter, chars in NON_ASCII_CASES.items()}


def test_filter_on_hits_does_not_repeat_the_search(spark):
    frame = messages(spark, ["an idiot", "fine", None]).repartition(2)
    dropped = drop_profane_messages(frame, ["idiot", "trash talk"], max_pattern_chars=0)
    assert texts(dropped) == [None, "fine"] or texts(dropped) == ["fine", None]
    plan = dropped._jdf.queryExecution().optimizedPlan().toString()
    # Cut into pieces once for the search and once for the text between the hits at most.
    assert plan.count("regexp_extract_all") <= 2


@pytest.mark.parametrize("listed", [5000, 1])
def test_only_words_of_the_lexicon_are_shuffled(spark, monkeypatch, listed):
    monkeypatch.setattr("chatloom.operators.censoring.MAX_LISTED", listed)
    raw = ["an idiot Scum", "fine and long text", None, "", "scum"]
    way = {"max_pattern_chars": 0, "max_table_chars": 0}
    frame = censor_messages(messages(spark, raw), ["idiot", "scum", "unused"], **way)
    assert texts(frame) == ["an *** ***", "fine and long text", None, "", "***"]
    assert frame.columns == messages(spark, raw).columns
    assert texts(drop_profane_messages(messages(spark, raw), ["idiot", "scum", "unused"], **way)) == ["fine and long text", None, ""]
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert ("word#" in plan and " IN (" in plan or " INSET " in plan) == (listed == 5000)
