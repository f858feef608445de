"""CRC-32 as a DuckDB expression, for the SQL of queries whose result carries one."""

from __future__ import annotations

#: The remainders of all bytes under the reversed polynomial 0xEDB88320, built in SQL.
TABLE = """(SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc_table)"""


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of the UTF-8 bytes of `text`; the query must have `crc_table` in scope."""
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    return (
        f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), "
        "lambda c, b: xor(c // 256, crc_table[xor(c % 256, b) + 1])), 4294967295)"
    )
