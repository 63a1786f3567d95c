"""The batch tasks as SQL text over a view ``chat``.

The plans are those of the DataFrame operators; use whichever reads better.
"""

from collections.abc import Iterable

from pyspark.sql import DataFrame

from ..functions.lexicon import MAX_PATTERN_CHARS, gap_pattern, mask_literal, word_pattern
from ..operators.censoring import LENGTH_MASK, censor_messages, drop_profane_messages

COUNT_MESSAGES = "SELECT count(*) AS n FROM {chat}"

CENSOR_MESSAGES = """
SELECT message_id, sent_at, user_id, channel_id, regexp_replace(text, :pattern, :mask) AS text
FROM {chat}
"""

CENSOR_MESSAGES_BY_LENGTH = """
SELECT message_id, sent_at, user_id, channel_id,
       CASE WHEN regexp_like(text, :pattern) THEN array_join(zip_with(
           slice(regexp_extract_all(text, :gaps, 1), 1, size(regexp_extract_all(text, :pattern, 0)) + 1),
           concat(transform(regexp_extract_all(text, :pattern, 0), hit -> repeat('*', char_length(hit))), array('')),
           (piece, star) -> concat(piece, star)), '')
       ELSE text END AS text
FROM {chat}
"""

DROP_PROFANE_MESSAGES = """
SELECT message_id, sent_at, user_id, channel_id, text
FROM {chat}
WHERE NOT coalesce(regexp_like(text, :pattern), false)
"""

TOP_CHANNELS = """
SELECT channel_id, count(*) AS n
FROM {chat}
GROUP BY channel_id
ORDER BY n DESC, channel_id
LIMIT :k
"""

TOP_USERS = """
SELECT user_id, count(*) AS n
FROM {chat}
GROUP BY user_id
ORDER BY n DESC, user_id
LIMIT :k
"""

TASKS = {
    "count_messages": COUNT_MESSAGES,
    "censor_messages": CENSOR_MESSAGES,
    "drop_profane_messages": DROP_PROFANE_MESSAGES,
    "top_channels": TOP_CHANNELS,
    "top_users": TOP_USERS,
}


def run_sql_task(
    task: str, chat: DataFrame, lexicon: Iterable[str] = (), mask: str = "***", k: int = 10
) -> DataFrame:
    """Runs one of ``TASKS`` on ``chat``. A lexicon that is too large for a pattern goes to the DataFrame operators."""
    text = TASKS[task]
    if task == "censor_messages" and mask == LENGTH_MASK:
        text = CENSOR_MESSAGES_BY_LENGTH
    args = {"k": k} if ":k" in text else {}
    if ":pattern" in text:
        words = [word for word in lexicon if word]
        if sum(map(len, words)) > MAX_PATTERN_CHARS:
            columns = ["message_id", "sent_at", "user_id", "channel_id", "text"]
            if task == "censor_messages":
                return censor_messages(chat, words, mask).select(*columns)
            return drop_profane_messages(chat, words).select(*columns)
        # A pattern that never matches stands for an empty lexicon.
        args["pattern"] = word_pattern(words) or "(?!)"
    if ":gaps" in text:
        args["gaps"] = gap_pattern(args["pattern"])
    if ":mask" in text:
        args["mask"] = mask_literal(mask)
    return chat.sparkSession.sql(text, args=args, chat=chat)
