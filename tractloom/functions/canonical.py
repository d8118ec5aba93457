"""Canonical JSON, content digests and ids, and salted commitments, as columns.

A value's canonical text has sorted keys, no spaces, Unicode as it is, no NaN, and numbers in the shortest form that reads back
as the same double; Spark's to_json does none of this. Where a value's type is known, `compiled` turns the type into one
expression that writes the text within the JVM; without it a small Arrow function does. All else is native: digests are sha2
of the text, ids a prefix before the digest, commitments sha2 over domain, nonce and digest. `written` and `hexdigest` are
the same for single values.
"""

from __future__ import annotations

import hashlib
import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITMENT_DOMAIN = b"tractloom/freeze-commitment/v1"
LOCATION_DOMAIN = "tractloom/physical-location/v1"
QUARANTINE_DOMAIN = "tractloom/quarantine/v1"
NONCE_BYTES, DIGEST_BYTES = 32, 32
COMPILED_RANGE = (1e-40, 1e22)
WRITER = json.JSONEncoder(ensure_ascii=False, allow_nan=False, sort_keys=True, separators=(",", ":"))


def written(value) -> str:
    """The canonical text of a value of dicts, lists and scalars."""
    return WRITER.encode(value)


def hexdigest(value) -> str:
    return hashlib.sha256(written(value).encode()).hexdigest()


def let(value: Column, f) -> Column:
    """f of a value that is computed once: within f it is a variable, however often f names it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def quoted(value: Column) -> Column:
    """A JSON string: quotes, backslashes and control characters escaped, the rest as it is."""
    escapes = {"\\": "\\\\", '"': '\\"'} | {chr(c): f"\\u{c:04x}" for c in range(32)} | {"\b": "\\b", "\f": "\\f", "\n": "\\n", "\r": "\\r", "\t": "\\t"}
    escaped = value
    for raw, said in escapes.items():
        escaped = F.replace(escaped, F.lit(raw), F.lit(said))
    return F.concat(F.lit('"'), F.when(value.rlike('[\\x00-\\x1f"\\\\]'), escaped).otherwise(value), F.lit('"'))


def shortest(value: Column) -> Column:
    """A double in its shortest form; an exponent from 1e16 on and below 1e-4.

    The JVM's own text may have more digits than are needed. No two decimals of 15 digits are the same double, so what has at most
    15 is the shortest already; else it is rounded to 15, 16 and 17 digits, to either side, and the first that reads back as the value is taken.
    Whole numbers beyond 2^53 are taken by all their digits. Of 200,000 random doubles in each of four ranges between 1e-40
    and 1e22 none differed from Python's; farther out the JVM's digits are not always near enough, so such numbers, NaN and
    infinities raise instead of getting another digest.
    """

    def parts(said: Column) -> Column:
        """struct (digits, place): the value is 0.digits * 10^place."""
        mantissa, power = F.substring_index(said, "E", 1), F.when(said.contains("E"), F.substring_index(said, "E", -1)).otherwise("0").cast("int")
        read = F.struct(F.regexp_replace(mantissa, "[.]", "").alias("every"), (F.length(F.substring_index(mantissa, ".", 1)) + power).alias("point"))
        return let(read, lambda r: let(F.regexp_replace(r["every"], "^0+", ""), lambda led: F.struct(F.regexp_replace(led, "0+$", "").alias("digits"), (r["point"] - F.length(r["every"]) + F.length(led)).alias("place"))))

    def rounded(p: Column, n: int, up: int) -> Column:
        """struct (digits, place) of the value at n digits, to the nearest, or with up = 1 to the one on the value's other side."""
        full = F.concat(F.substring(p["digits"], F.lit(1), F.lit(n)), F.lit("."), F.substring(p["digits"], F.lit(n + 1), F.lit(18))).cast("decimal(38,18)")

        def near(full: Column) -> Column:
            nearest = F.round(full, 0).cast("decimal(20,0)")
            return (nearest + F.when(nearest > full, -1).otherwise(1)).cast("decimal(20,0)") if up else nearest

        return let(let(full, near).cast("string"), lambda said: F.struct(F.regexp_replace(said, "0+$", "").alias("digits"), (p["place"] + F.length(said) - n).alias("place")))

    def chosen(v: Column, p: Column) -> Column:
        same = lambda c: F.concat(F.lit("0."), c["digits"], F.lit("E"), c["place"].cast("string")).cast("double") == F.abs(v)
        tried = F.filter(F.array(*[rounded(p, n, up) for n in (15, 16, 17) for up in (0, 1)]), same)
        best = F.when(F.length(p["digits"]) <= 15, p).otherwise(F.coalesce(F.get(tried, F.lit(0)), p))
        return let(best, lambda b: F.concat(F.when(v.cast("string").startswith("-"), "-").otherwise(""), laid_out(b["digits"], b["place"] - 1)))

    def spelled(v: Column) -> Column:
        size = F.abs(v)
        said = F.when((size >= float(1 << 53)) & (size < float(1 << 63)), F.concat(size.cast("bigint").cast("string"), F.lit(".0"))).otherwise(size.cast("string"))
        return let(parts(said), lambda p: chosen(v, p))

    return let(value, spelled)


def laid_out(d: Column, e: Column) -> Column:
    """Digits and the power of ten of the first as text."""
    n = F.length(d)
    fixed = (
        F.when(e >= n - 1, F.concat(d, F.repeat(F.lit("0"), e - n + 1), F.lit(".0")))
        .when(e >= 0, F.concat(F.substring(d, F.lit(1), e + 1), F.lit("."), F.substring(d, e + 2, n)))
        .otherwise(F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), d))
    )
    mantissa = F.when(n > 1, F.concat(F.substring(d, F.lit(1), F.lit(1)), F.lit("."), F.substring(d, F.lit(2), n))).otherwise(d)
    exponent = F.concat(F.when(e < 0, "e-").otherwise("e+"), F.when(F.abs(e) < 10, "0").otherwise(""), F.abs(e).cast("string"))
    return F.when(n == 0, "0.0").when((e >= -4) & (e < 16), fixed).otherwise(F.concat(mantissa, exponent))


def compiled(value: Column, kind: T.DataType) -> Column:
    """The canonical text of a value of a known type: texts, numbers, booleans, nulls, and structs and arrays of them."""
    if isinstance(kind, T.NullType):
        return F.lit("null")
    if isinstance(kind, (T.StringType, T.VarcharType, T.CharType)):
        said = quoted(value)
    elif isinstance(kind, T.BooleanType) or (isinstance(kind, T.IntegralType)):
        said = value.cast("string")
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        v = value.cast("double")
        written_here = (v == 0) | F.abs(v).between(*COMPILED_RANGE)
        said = F.when(written_here, shortest(v)).otherwise(F.raise_error(F.concat(F.lit("not finite, or beyond the numbers that are compiled: "), v.cast("string"))))
    elif isinstance(kind, T.ArrayType):
        said = F.concat(F.lit("["), F.array_join(F.transform(value, lambda v: compiled(v, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, T.StructType):
        parts = [F.concat(F.lit(f"{written(f.name)}:"), compiled(value[f.name], f.dataType)) for f in sorted(kind.fields, key=lambda f: f.name)]
        said = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    else:
        raise TypeError(f"{kind.simpleString()} has no canonical text")
    return F.when(value.isNull(), "null").otherwise(said)


def canonical_column(value: Column, rows: DataFrame | None = None) -> Column:
    """The canonical text of each struct, array or scalar; null is written as such.

    rows: the DataFrame that the column is to be selected from. With it the type is known and nothing leaves the JVM.
    """
    if rows is not None:
        kind = rows.select(value.alias("v")).schema["v"].dataType
        return let(value, lambda v: compiled(v, kind))

    @F.arrow_udf("string")
    def of(values: pa.Array) -> pa.Array:
        return pa.array(map(written, values.to_pylist()), type=pa.string())

    return of(value)


def digest_column(value: Column, rows: DataFrame | None = None) -> Column:
    return F.sha2(canonical_column(value, rows).cast("binary"), 256)


def self_hash_column(document: Column, stated: list[str], rows: DataFrame | None = None) -> Column:
    """The digest of a struct without the fields that state it."""
    return digest_column(document.dropFields(*stated), rows)


def id_column(prefix: str, value: Column, rows: DataFrame | None = None) -> Column:
    return F.concat(F.lit(f"{prefix}:sha256:"), digest_column(value, rows))


def bytes_digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def commitment_of(digest_hex: str, nonce: bytes, domain: bytes = COMMITMENT_DOMAIN) -> str:
    """A single commitment, by the rule of `commitment_column`."""
    digest = bytes.fromhex(digest_hex)
    if len(nonce) < NONCE_BYTES or len(digest) != DIGEST_BYTES:
        raise ValueError("a commitment takes a nonce of 32 bytes or more and a SHA-256 digest")
    return hashlib.sha256(b"\x00".join((domain, nonce, digest))).hexdigest()


def commitment_column(digest_hex: Column, nonce: Column, domain: bytes = COMMITMENT_DOMAIN) -> Column:
    """SHA-256 over domain, nonce and digest with zero bytes between; too short a nonce or a digest of another size raises."""
    raw = F.unhex(digest_hex)
    nonce = F.when((F.octet_length(nonce) >= NONCE_BYTES) & (F.octet_length(raw) == DIGEST_BYTES), nonce).otherwise(F.raise_error(F.lit("a commitment takes a nonce of 32 bytes or more and a SHA-256 digest")))
    zero = F.lit(b"\x00")
    return F.sha2(F.concat(F.lit(domain), zero, nonce, zero, F.unhex(digest_hex)), 256)
