"""What went wrong, in words that say what to do about it."""

from __future__ import annotations

import re


class SchemaOutOfSync(RuntimeError):
    """The log names a table or column that the schema history doesn't have."""


# Parts of messages, and what they mean for a reader.
HINTS = (
    (r"has purged|purged .*binary logs?|no file .* any more", "The log before the wanted offset is gone. Keep it longer, or start with a new snapshot."),
    (r"(?i)server[_ ]?id", "Another reader uses this server id. Give each job a range of its own, one id for each reader."),
    (r"(?i)communications link|connection (reset|refused)", "The server can't be reached. Check host, port and network; reading goes on from the last offset."),
    (r"(?i)access denied", "The user lacks rights. Reading needs SELECT, REPLICATION SLAVE and REPLICATION CLIENT."),
)


def classify(error: BaseException | str) -> BaseException:
    """The error as it is, as a SchemaOutOfSync where its text says so, or with a hint."""
    text = str(error)
    if re.search(r"(?i)schema.*(isn't known|is not known|out of sync)|data row is smaller than a column index", text):
        out: BaseException = SchemaOutOfSync(f"{text}\nThe table's schema changed outside the recorded history. Restart with a new snapshot of it.")
    else:
        hint = next((h for pattern, h in HINTS if re.search(pattern, text)), None)
        out = RuntimeError(f"{text}\n{hint}") if hint else error if isinstance(error, BaseException) else RuntimeError(text)
    if isinstance(error, BaseException) and out is not error:
        out.__cause__ = error
    return out
