"""Brute-force versions of the operators, for small inputs."""

from chatloom.functions.lexicon import fold_word

MESSAGE_DDL = (
    "message_id bigint, sent_at timestamp_ntz, user_id bigint, channel_id bigint, text string"
)


def messages(spark, texts):
    """One message per text; ids count up from 0."""
    rows = [(i, None, i % 3, i % 2, text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, MESSAGE_DDL)


def texts(frame):
    return [row["text"] for row in frame.orderBy("message_id").collect()]


def is_word_char(char):
    return char == "_" or char.isalnum()


def find_hits(text, words):
    """Leftmost-longest whole-word hits as (start, end)."""
    folded, wanted = fold_word(text), sorted(map(fold_word, words), key=len, reverse=True)
    hits, at = [], 0
    while at < len(text):
        for word in wanted:
            end = at + len(word)
            inside = at > 0 and is_word_char(text[at - 1])
            inside = inside or (end < len(text) and is_word_char(text[end]))
            if word and folded[at:end] == word and not inside:
                hits.append((at, end))
                at = end
                break
        else:
            at += 1
    return hits


def mask_text(text, words, mask):
    if text is None:
        return None
    parts, at = [], 0
    for start, end in find_hits(text, words):
        parts += [text[at:start], "*" * (end - start) if mask == "length" else mask]
        at = end
    return "".join([*parts, text[at:]])
