"""crc32 of an ASCII string in DuckDB SQL, which has no such function."""

from __future__ import annotations

#: A common table expression with the 256 remainders, as one list ``t``.
CRC_TABLE = """
crc_table AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_concat([CAST(i AS BIGINT)], CAST(range(8) AS BIGINT[])),
    lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS r(i)))
"""


def crc32(text: str, table: str = "t") -> str:
    """The expression for a string expression; ``table`` is the list of ``crc_table`` in reach."""
    letters = f"list_transform(string_split({text}, ''), lambda b: CAST(ascii(b) AS BIGINT))"
    return (f"xor(list_reduce(list_concat([4294967295], {letters}), "
            f"lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])), 4294967295)")
