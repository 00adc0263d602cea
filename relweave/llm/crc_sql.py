"""CRC-32 in DuckDB SQL, for the queries whose contract deals rows by it."""

#: A table ``crc`` with the list ``steps``: the remainder of each of the 256 bytes.
CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    [i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS steps
)"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a SQL text expression, where ``steps`` is a column."""
    digits = f"hex(encode({text}))"
    octets = f"list_transform(range(length({digits}) // 2), lambda i: CAST('0x' || {digits}[2 * i + 1:2 * i + 2] AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)"
