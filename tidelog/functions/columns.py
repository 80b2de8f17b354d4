"""Column expressions for event paths, bytes and enums. All are built-in functions; none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dotted(path: Column) -> Column:
    """An integer path as dotted text: [3, 1] is ``3.1``."""
    return F.array_join(F.transform(path, lambda x: x.cast("string")), ".")


def path_key(text: Column) -> Column:
    """A dotted path as integers, which order segment by segment: 3 < 3.1 < 10."""
    return F.split(text, "[.]").cast("array<int>")


def path_indexes(path: Column) -> tuple[Column, Column]:
    """(ix_index, inner_index) of a path; -1 is the top level, and deeper paths collapse on their second element."""
    outer = F.get(path, F.lit(0)).cast("smallint")
    inner = F.when(F.size(path) == 1, F.lit(-1)).otherwise(F.get(path, F.lit(1))).cast("smallint")
    return outer, inner


def row_id(signature: Column, outer: Column, inner: Column) -> Column:
    """``sig-3`` at the top level, ``sig-3.1`` below."""
    return F.concat_ws("-", signature, F.when(inner < 0, outer.cast("string")).otherwise(F.concat_ws(".", outer.cast("string"), inner.cast("string"))))


def account_at(accounts: Column, position: Column | int) -> Column:
    """The account at a position from 0, or NULL beyond the list's end."""
    position = F.lit(position) if isinstance(position, int) else position
    return F.try_element_at(accounts, (position + 1).cast("int"))


def worked_out(rows: DataFrame) -> DataFrame:
    """The same rows, each column worked out once: a filter over them isn't pushed to where it would repeat what they are made of.

    For costly columns, such as parsed payloads, that a filter and the rows after it both use.
    """
    return rows.select(F.explode(F.array(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))).alias("_row")).select("_row.*")


def lossy_text(data: Column) -> Column:
    """Bytes as UTF-8 text; bad sequences become the replacement character."""
    return F.make_valid_utf8(data.cast("string"))


def lower_hex(data: Column) -> Column:
    return F.lower(F.hex(data))


def wrapped_u64(hex_digits: Column) -> Column:
    """A big-endian unsigned 64-bit number in hex as a signed one; large values wrap to negative ones."""
    return F.conv(hex_digits, 16, -10).cast("bigint")


def little_endian(data: Column, offset: int, width: int, signed: bool = False) -> Column:
    """An integer field of a binary payload; NULL if the payload is too short.

    Unsigned fields of 1, 2, 4 and 8 bytes become short, int, long and (wrapped) long. Byte order is
    turned on hex digits, since reversing a binary column reverses characters, not bytes.
    """
    digits = F.hex(data)
    turned = F.concat(*[F.substring(digits, 2 * (offset + k) + 1, 2) for k in reversed(range(width))])
    value = F.conv(turned, 16, -10).cast("bigint")
    if signed and width < 8:
        value = F.when(value >= 1 << (8 * width - 1), value - (1 << (8 * width))).otherwise(value)
    kind = {1: "smallint", 2: "int"}.get(width, "bigint")
    return F.when(F.octet_length(data) >= offset + width, value).cast(kind)


def payload_bytes(data: Column, offset: int, width: int) -> Column:
    """A fixed run of bytes of a payload, or NULL if it is too short."""
    return F.when(F.octet_length(data) >= offset + width, F.substring(data, offset + 1, width))


def spelled(index: Column, names: tuple[str, ...]) -> Column:
    """An enum's index as its spelling; NULL for an unknown one."""
    return F.get(F.array(*[F.lit(n) for n in names]), index.cast("int"))


def indexed(name: Column, names: tuple[str, ...]) -> Column:
    """An enum's spelling as its index; NULL for an unknown one."""
    found = F.array_position(F.array(*[F.lit(n) for n in names]), name)
    return F.when(found > 0, found - 1).cast("smallint")


def checked(value: Column, names: tuple[str, ...], what: str) -> Column:
    """The enum value itself; a NULL or unknown spelling is an error, not NULL."""
    known = value.isin(*names)
    return F.when(F.coalesce(known, F.lit(False)), value).otherwise(F.raise_error(F.concat(F.lit(f"unknown {what}: "), F.coalesce(value, F.lit("NULL")))))


def saturated_int(n: Column) -> Column:
    """A count as int; larger ones become the largest int."""
    return F.least(n, F.lit(2_147_483_647)).cast("int")


def flattened(struct: str, fields: list[str], prefix: str | None = None) -> list[Column]:
    """A nested struct's fields as columns with a prefix."""
    prefix = struct if prefix is None else prefix
    return [F.col(f"{struct}.{f}").alias(f"{prefix}_{f}") for f in fields]


def json_list(items: Column, fields: list[str]) -> Column:
    """A list of structs as a JSON list of the given fields."""
    return F.to_json(F.transform(items, lambda x: F.struct(*[x[f].alias(f) for f in fields])))


def public_name(column: str) -> str:
    """A column's public spelling: ``added_at_slot`` is ``addedAtSlot``."""
    first, *rest = column.split("_")
    return first + "".join(x.capitalize() for x in rest)


def key_argument(text: str, length: int = 32) -> bytes:
    """A hex key argument; wrong digits or a wrong length are an error for the caller."""
    try:
        key = bytes.fromhex(text)
    except ValueError as e:
        raise ValueError(f"not a hex key: {text!r}") from e
    if len(key) != length:
        raise ValueError(f"a key has {length} bytes, not {len(key)}")
    return key
