"""Statement texts as columns: classification and clean-up of whole tables of SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that may not occur in a guarded statement, and the messages.
DISALLOWED = (
    "INSERT", "UPDATE", "DELETE", "DROP", "ALTER", "CREATE", "TRUNCATE", "ATTACH", "DETACH", "COPY",
    "EXPORT", "IMPORT", "CALL", "PRAGMA", "SET", "INSTALL", "LOAD", "VACUUM", "GRANT", "REVOKE",
)
EMPTY = "Empty query."
SEVERAL = "Multiple statements are not allowed."
NOT_SELECT = "Only SELECT (or WITH ... SELECT) statements are allowed."
KEYWORD = "Disallowed keyword in query: "

OPENING = r"(?iU)^(WITH|SELECT)\b"
KEYWORD_PATTERN = r"(?iU)\b(" + "|".join(DISALLOWED) + r")\b"

# Fixed value: every character that counts as white space.
WHITE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def trimmed(text: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(text, F.lit(WHITE))


def statement_body(sql: Column) -> Column:
    return F.rtrim(trimmed(sql), F.lit(";"))


def rejection(sql: Column) -> Column:
    """Why a statement may not run, or NULL if it is one plain SELECT.

    Strict by intent: a semicolon or a listed word inside a literal rejects too.
    """
    body = statement_body(sql)
    word = F.regexp_extract(body, KEYWORD_PATTERN, 1)
    return (
        F.when(sql.isNull() | (body == ""), EMPTY)
        .when(body.contains(";"), SEVERAL)
        .when(~body.rlike(OPENING), NOT_SELECT)
        .when(word != "", F.concat(F.lit(KEYWORD), word))
    )


def sql_of_reply(reply: Column) -> Column:
    """The statement in a model's reply: code fences, if any, and closing semicolons go."""
    opened = F.regexp_replace(trimmed(reply), r"(?i)^```(?:sql)?\s*", "")
    closed = F.regexp_replace(opened, r"```\s*$", "")
    return statement_body(closed)
