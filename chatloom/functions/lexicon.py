"""From a list of words to one regular expression that finds them as whole words."""

from collections.abc import Iterable

# A word character is a letter, a digit or an underscore, in any script.
WORD_CHAR = r"[\p{L}\p{N}_]"

# The pattern travels inside the plan and is compared per row, so its size is bounded. Larger
# lexicons go through censoring's join.
MAX_PATTERN_CHARS = 500_000


# The characters beyond ASCII that are equal to an ASCII letter but for case.
NON_ASCII_CASES = {"i": "\u0130\u0131", "k": "\u212a", "s": "\u017f"}


def fold_char(char: str) -> str:
    """The representative that case-insensitive Unicode matching compares: lower(upper(c))."""
    upper = char.upper() if len(char.upper()) == 1 else char
    return upper.lower()[0]


def fold_word(word: str) -> str:
    return "".join(map(fold_char, word))


def clean_words(words: Iterable[str | None]) -> list[str]:
    """Folded, distinct, non-empty words in a stable order."""
    return sorted({fold_word(word) for word in words if word})


def is_plain_word(word: str) -> bool:
    """Whether ``word`` is a single run of word characters."""
    return all(char == "_" or char.isalnum() for char in word)


def word_pattern(words: Iterable[str | None]) -> str | None:
    """A pattern for any of ``words`` as whole words, or None for an empty lexicon.

    Shared prefixes are factored out. A flat alternation tries every word at every word start,
    which makes its cost linear in the lexicon; the factored form only walks down matching letters.
    A longer word is tried before its own prefix, so hits are leftmost-longest.
    """
    cleaned = clean_words(words)
    if not cleaned:
        return None
    root: dict = {}
    for word in cleaned:
        node = root
        for char in word:
            node = node.setdefault(char, {})
        node[""] = {}
    end = f"(?!{WORD_CHAR})"
    if len(root) == 1 or not all(map(str.isascii, root)):
        return rf"(?iu)(?<!{WORD_CHAR})(?:{_branches(root)}){end}"
    # Most places of a text are ruled out by one or two looks into a table, if a match begins with a plain set of
    # characters; what stands before it, and which of them it is, is asked afterwards, looking back.
    seconds = {char for child in root.values() for char in child}
    ahead = f"(?={_any_case(seconds)})" if all(char and char.isascii() for char in seconds) else ""
    options = "|".join(f"(?<={_quote(char)}){_branches(child)}" for char, child in root.items())
    return rf"{_any_case(root)}{ahead}(?<!\w(?s:.))(?iu)(?<!{WORD_CHAR}(?s:.))(?:{options}){end}"


def gap_pattern(pattern: str) -> str:
    """A pattern whose first group is what stands before each match of ``pattern``, and after the last."""
    return rf"(?s)(.*?)(?:{pattern}|\z)"


def mask_literal(mask: str) -> str:
    """``mask`` with the characters that are special in a replacement string escaped."""
    return mask.replace("\\", "\\\\").replace("$", "\\$")


def _any_case(chars: Iterable[str]) -> str:
    """A set, for a match that heeds case, of ASCII characters and all that are equal to them but for case."""
    members = {variant for char in chars for variant in (char, char.upper(), *NON_ASCII_CASES.get(char, ""))}
    return f"[{''.join(map(_quote, sorted(members)))}]"


def _quote(char: str) -> str:
    if char == "ß":  # has no upper case of its own, so its capital form must be named
        return "[ßẞ]"
    return char if char == "_" or char.isalnum() else rf"\x{{{ord(char):x}}}"


def _branches(node: dict) -> str:
    """The sub-pattern below ``node``; runs without a branch are followed in a loop."""
    prefix = []
    while len(node) == 1 and "" not in node:
        char, node = next(iter(node.items()))
        prefix.append(_quote(char))
    if set(node) == {""}:
        return "".join(prefix)
    options = "|".join(_quote(char) + _branches(child) for char, child in node.items() if char)
    return f"{''.join(prefix)}(?:{options}){'?' if '' in node else ''}"
