"""Functions on numbers, JSON, arrays, maps and bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_percent(part: Column, whole: Column) -> Column:
    """100 * part over whole, rounded down; a whole of 0 counts as 1."""
    return F.call_function("floor", (part * 100) / F.greatest(whole, F.lit(1))).cast("long")


def half_even(c: Column, digits: int = 0) -> Column:
    """Rounded half to even."""
    return F.bround(c, digits)


def json_path(c: Column, path: str, kind: str = "string", default=None) -> Column:
    """A value inside a JSON text; the default for malformed texts and missing paths."""
    found = F.try_variant_get(F.try_parse_json(c), path, kind)
    return found if default is None else F.coalesce(found, F.lit(default))


def json_map(c: Column, value: str = "string") -> Column:
    """A JSON object as a map; an empty map for anything else."""
    return F.coalesce(F.from_json(c, f"map<string,{value}>"), F.create_map().cast(f"map<string,{value}>"))


def json_array(c: Column, value: str = "string") -> Column:
    """A JSON array; an empty one for anything else."""
    return F.coalesce(F.from_json(c, f"array<{value}>"), F.array().cast(f"array<{value}>"))


def real_keys(m: Column) -> Column:
    """The map without empty keys and keys that begin with ``_``."""
    return F.map_filter(m, lambda k, _: (k != "") & ~k.startswith("_"))


def same_keys(*maps: Column) -> Column:
    """Whether all maps have the same keys; a null map has none."""
    keys = [F.coalesce(F.array_sort(F.map_keys(m)), F.array().cast("array<string>")) for m in maps]
    out = F.lit(True)
    for k in keys[1:]:
        out = out & (keys[0] == k)
    return out


def texts_of(items: Column, field: str) -> Column:
    """A field of an array of structs, without blanks, in order."""
    return F.filter(F.transform(items, lambda x: F.trim(F.coalesce(x[field], F.lit("")))), lambda x: x != "")


def joined_or(items: Column, separator: str, default: str) -> Column:
    """The items joined; the default if there are none."""
    return F.coalesce(F.nullif(F.array_join(items, separator), F.lit("")), F.lit(default))


def fixed_slots(items: Column, n: int, prefix: str) -> list[Column]:
    """The first n items as n columns, padded with empty strings."""
    return [F.coalesce(F.try_element_at(items, F.lit(k + 1)), F.lit("")).alias(f"{prefix}_{k + 1}") for k in range(n)]


def reasons(pairs: list[tuple[Column, str]], separator: str = ";") -> Column:
    """The texts whose conditions hold, in order, joined."""
    return F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(t)) for c, t in pairs])), separator)


def retryable(status: Column) -> Column:
    """Whether a request with this status is worth repeating: 429 and 500 to 599."""
    return F.coalesce((status == 429) | status.between(500, 599), F.lit(False))


def failure_class(status: Column) -> Column:
    """``http_4xx`` for statuses 400 to 499 but 429, else ``network``."""
    return F.when(status.between(400, 499) & (status != 429), F.lit("http_4xx")).otherwise(F.lit("network"))


def intact(content: Column, kind: Column) -> Column:
    """(strict, lenient): whether a file's bytes begin as its kind's do; lenient also takes any audio over 100 bytes."""
    size, head = F.length(content), F.substring(content, 1, 12)
    at = lambda i, n: F.substring(content, i, n)
    pdf = head.startswith(F.lit(b"%PDF"))
    m4a = at(5, 4) == F.lit(b"ftyp")
    sync = (at(1, 1) == F.lit(b"\xff")) & (F.conv(F.hex(at(2, 1)), 16, 10).cast("int") >= 224)
    mp3 = head.startswith(F.lit(b"ID3")) | sync
    strict = F.when(kind == "pdf", pdf).when(kind == "m4a", m4a).when(kind == "mp3", mp3).otherwise(F.lit(True)) & (size > 0)
    lenient = F.when(kind.isin("m4a", "mp3"), strict | (size > 100)).otherwise(strict)
    return F.struct(F.coalesce(strict, F.lit(False)).alias("strict"), F.coalesce(lenient, F.lit(False)).alias("lenient"))


def period(signature: Column) -> Column:
    """(period, repeats): the least p with s[i] = s[i + p] for all i; (1, true) for one element, (0, false) if none."""
    n = F.size(signature)
    fits = F.filter(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda p: F.forall(F.sequence(F.lit(0), F.greatest(n - p - 1, F.lit(0))), lambda i: F.get(signature, i).eqNullSafe(F.get(signature, i + p))))
    least = F.when(n == 1, F.lit(1)).otherwise(F.coalesce(F.get(F.filter(fits, lambda p: p < n), F.lit(0)), F.lit(0)))
    return F.struct(F.when(n > 0, least).otherwise(F.lit(0)).alias("period"), ((n > 0) & (least > 0)).alias("repeats"))


def shared_tail(boxes: Column) -> Column:
    """Of an array of stanzas (arrays of lines): the lines from the second on that are equal in all stanzas, up to the
    first that isn't; none for fewer than two stanzas."""
    n = F.size(boxes)
    first = F.get(boxes, F.lit(0))
    rest = F.when((n > 1) & (F.size(first) > 1), F.sequence(F.lit(1), F.size(first) - 1)).otherwise(F.array().cast("array<int>"))
    equal = F.transform(rest, lambda j: F.forall(boxes, lambda b: F.get(b, j).eqNullSafe(F.get(first, j))))
    stop = F.coalesce(F.nullif(F.array_position(equal, F.lit(False)), F.lit(0)) - 1, F.size(rest)).cast("int")
    return F.slice(first, F.lit(2), stop)
