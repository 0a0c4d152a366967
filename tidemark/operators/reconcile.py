"""Differences between two copies of a table by set reconciliation.

Each side turns its rows into elements of GF(2^61 - 1) and sends, for each bucket of elements, only the number of
distinct elements and the values of the bucket's characteristic polynomial, the product of (z - element), at a few
fixed points. The quotient of the two sides' values is a rational function whose numerator and denominator have just
the differing elements as roots. It is interpolated under a bound on its degree; the bound is doubled until the points
not used for it verify the result. Buckets that differ too much for the points are cut into 16 and sent again. The
differing elements lead to keys, and the rows of these keys are fetched from both sides and compared field by field.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import row_hash
from tidemark.session import cut

PRIME = 2**61 - 1
#: Points a bucket is evaluated at, those of them kept back to verify, rows a bucket should hold.
POINTS, VERIFY, BUCKET_ROWS = 20, 4, 64
#: Buckets, most of which need no decoding, that one task decodes.
BUCKETS_PER_TASK = 10_000


def points(seed: int, n: int = POINTS) -> list[int]:
    r = random.Random(seed)
    return [r.randrange(PRIME) for _ in range(n)]


def _fold(x: np.ndarray) -> np.ndarray:
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(61))
    return np.where(x >= np.uint64(PRIME), x - np.uint64(PRIME), x)


def mulmod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b mod 2^61 - 1 of uint64 arrays below the modulus."""
    low31, low30 = np.uint64(2**31 - 1), np.uint64(2**30 - 1)
    a1, a0, b1, b0 = a >> np.uint64(31), a & low31, b >> np.uint64(31), b & low31
    mid = a1 * b0 + a0 * b1
    return _fold(((a1 * b1) << np.uint64(1)) + (mid >> np.uint64(30)) + ((mid & low30) << np.uint64(31)) + a0 * b0)


def evaluate(sets: list[np.ndarray], at: list[int]) -> np.ndarray:
    """Values of the characteristic polynomials of the sets at the points: one row a set."""
    z = np.array(at, dtype=np.uint64)
    out = np.ones((len(sets), len(at)), dtype=np.uint64)
    lengths = np.array([len(s) for s in sets])
    order = np.argsort(-lengths, kind="stable")  # so that the sets that still have elements stand in front
    if not len(sets) or not lengths.max():
        return out
    padded = np.zeros((len(sets), int(lengths.max())), dtype=np.uint64)
    for i, k in enumerate(order):
        padded[i, : lengths[k]] = sets[k]
    acc, live = np.ones_like(out), lengths[order]
    for j in range(padded.shape[1]):
        n = int(np.searchsorted(-live, -j, side="left"))
        h = padded[:n, j][:, None]
        factor = np.where(z[None, :] >= h, z[None, :] - h, z[None, :] + np.uint64(PRIME) - h)
        acc[:n] = mulmod(acc[:n], factor)
    out[order] = acc
    return out


# --- polynomials over the field, lowest coefficient first ---


def _trim(p: list[int]) -> list[int]:
    while p and p[-1] == 0:
        p.pop()
    return p


def _divmod(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    a, inv, q = a[:], 1 if b[-1] == 1 else pow(b[-1], -1, PRIME), [0] * max(0, len(a) - len(b) + 1)
    for i in range(len(q) - 1, -1, -1):
        q[i] = c = a[i + len(b) - 1] * inv % PRIME
        if c:
            for j, x in enumerate(b):
                a[i + j] = (a[i + j] - c * x) % PRIME
    return _trim(q), _trim(a[: len(b) - 1])


def _gcd(a: list[int], b: list[int]) -> list[int]:
    while b:
        a, b = b, _divmod(a, b)[1]
    inv = pow(a[-1], -1, PRIME)
    return [x * inv % PRIME for x in a]


def _mul(a: list[int], b: list[int], modulus: list[int]) -> list[int]:
    """a * b modulo a monic polynomial. Sums of products stay unreduced until a coefficient is used."""
    out, d = [0] * (len(a) + len(b) - 1) if a and b else [], len(modulus) - 1
    for i, x in enumerate(a):
        for j, y in enumerate(b, i):
            out[j] += x * y
    low = modulus[:-1]
    for top in range(len(out) - 1, d - 1, -1):
        c = out[top] % PRIME
        if c:
            for j, x in enumerate(low, top - d):
                out[j] -= c * x
    return _trim([x % PRIME for x in out[:d]])


def _squared(base: list[int], times: int, modulus: list[int]) -> list[int]:
    """base^(2^times) modulo a monic polynomial."""
    for _ in range(times):
        base = _mul(base, base, modulus)
    return base


def _at(p: list[int], z: int) -> int:
    out = 0
    for c in reversed(p):
        out = (out * z + c) % PRIME
    return out


def _minus(a: list[int], b: list[int]) -> list[int]:
    n = max(len(a), len(b))
    return _trim([(x - y) % PRIME for x, y in zip(a + [0] * (n - len(a)), b + [0] * (n - len(b)), strict=True)])


def roots(p: list[int]) -> list[int] | None:
    """The roots of a monic polynomial that is a product of different linear factors; None if it isn't."""
    if len(p) <= 1:
        return []
    if len(p) == 2:
        return [-p[0] % PRIME]
    # x^q = x holds exactly for such products. As q + 1 is a power of two, x^(q + 1) = x^2 is quicker to see; it says the
    # same unless x^2 divides p.
    if p[:2] == [0, 0] or _squared([0, 1], 61, p) != _mul([0, 1], [0, 1], p):
        return None
    out, todo, r = [], [p], random.Random(p[0])
    while todo:
        f = todo.pop()
        if len(f) == 2:
            out.append(-f[0] % PRIME)
            continue
        while True:
            # h^(2^60) = h where h is 0 or a square: about half of the roots, for a random h.
            h = [r.randrange(PRIME), 1]
            same = _minus(_squared(h, 60, f), h)
            g = _gcd(f, same) if same else f
            if 1 < len(g) < len(f):
                break
        todo += [g, _divmod(f, g)[0]]
    return out


def _solve(m: list[list[int]]) -> list[int]:
    """A solution of the linear system whose rows end with the right-hand side; free variables are 0."""
    n, pivots, r = len(m[0]) - 1, [], 0
    for c in range(n):
        k = next((i for i in range(r, len(m)) if m[i][c]), None)
        if k is None:
            continue
        m[r], m[k] = m[k], m[r]
        inv = pow(m[r][c], -1, PRIME)
        m[r] = [x * inv % PRIME for x in m[r]]
        for i in range(len(m)):
            if i != r and m[i][c]:
                f = m[i][c]
                m[i] = [(x - f * y) % PRIME for x, y in zip(m[i], m[r], strict=True)]
        pivots.append(c)
        r += 1
    out = [0] * n
    for i, c in enumerate(pivots):
        out[c] = m[i][-1]
    return out


def decode(n_a: int, n_b: int, of_a: list[int], of_b: list[int], at: list[int], verify: int = VERIFY) -> tuple[list[int], list[int]] | None:
    """Elements only in A and only in B from the two sides' counts and values; None if the points don't suffice."""
    if n_a == n_b and of_a == of_b:
        return [], []
    if 0 in of_b or 0 in of_a:  # a point hit an element
        return None
    f, delta = [x * pow(y, -1, PRIME) % PRIME for x, y in zip(of_a, of_b, strict=True)], n_a - n_b
    bound = max(1, abs(delta))
    while True:
        d = bound + (bound - delta) % 2
        if d + verify > len(at):
            return None
        up, down = (d + delta) // 2, (d - delta) // 2
        system = []
        for z, v in zip(at[:d], f[:d], strict=True):
            row, x = [], 1
            for _ in range(up):
                row.append(x)
                x = x * z % PRIME
            top, x = x, 1
            for _ in range(down):
                row.append(-v * x % PRIME)
                x = x * z % PRIME
            system.append([*row, (v * x - top) % PRIME])
        s = _solve(system)
        p, q = [*s[:up], 1], [*s[up:], 1]
        if all(_at(p, z) == v * _at(q, z) % PRIME for z, v in zip(at[d:], f[d:], strict=True)):
            g = _gcd(p[:], q[:])
            p, q = _divmod(p, g)[0], _divmod(q, g)[0]
            a, b = roots(p), roots(q)
            if a is not None and b is not None:
                return a, b
        bound *= 2


def _sketches(elements: DataFrame, buckets: int, at: list[int]) -> DataFrame:
    """(bucket, n, at_points) of one side. Repeated elements collapse before the shuffle, in collect_set."""

    @F.pandas_udf("array<bigint>")
    def values(sets: pd.Series) -> pd.Series:
        v = evaluate([np.asarray(s, dtype=np.uint64) for s in sets], at).astype(np.int64)
        return pd.Series(list(v))

    return (
        elements.groupBy(F.pmod("element", F.lit(buckets)).alias("bucket"))
        .agg(F.collect_set("element").alias("_set"))
        .select("bucket", F.size("_set").alias("n"), values("_set").alias("at_points"))
    )


def differing_elements(a: DataFrame, b: DataFrame, rows: int, *, bucket_rows: int = BUCKET_ROWS, n_points: int = POINTS) -> DataFrame:
    """(element, in_a) of the elements that only one side has, from frames with a BIGINT column element below 2^61 - 1."""
    spark, buckets, done, failing, level = a.sparkSession, max(1, rows // bucket_rows), None, None, 0
    while True:
        at = points(level, n_points)

        def decoded(batches: Iterator[pa.RecordBatch], at: list[int] = at) -> Iterator[pa.RecordBatch]:
            one = [1] * len(at)
            for batch in batches:
                out = []
                for bucket, n_a, n_b, va, vb in zip(*(batch.column(c).to_pylist() for c in ("bucket", "n_a", "n_b", "v_a", "v_b")), strict=True):
                    got = decode(n_a, n_b, va or one, vb or one, at)
                    if got is None:
                        out.append((bucket, None, None))
                    else:
                        out += [(bucket, e, True) for e in got[0]] + [(bucket, e, False) for e in got[1]]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.bool_()))], ["bucket", "element", "in_a"])

        sides = []
        for side, name in ((a, "a"), (b, "b")):
            e = side if failing is None else side.withColumn("bucket", F.pmod("element", F.lit(buckets // 16))).join(failing, "bucket", "left_semi").drop("bucket")
            sides.append(_sketches(e, buckets, at).select("bucket", F.col("n").alias(f"n_{name}"), F.col("at_points").alias(f"v_{name}")))
        joined = sides[0].join(sides[1], "bucket", "full").na.fill(0, ["n_a", "n_b"])
        # Buckets whose values agree need no decoding and don't go to Python.
        joined = joined.where((F.col("n_a") != F.col("n_b")) | ~F.col("v_a").eqNullSafe(F.col("v_b")))
        # Decoding costs milliseconds a bucket but few bytes, so its tasks are sized by buckets, not by bytes.
        joined = joined.repartition(max(spark.sparkContext.defaultParallelism, buckets // BUCKETS_PER_TASK))
        got = cut(joined.mapInArrow(decoded, "bucket bigint, element bigint, in_a boolean"))
        found = got.where(F.col("element").isNotNull()).select("element", "in_a")
        done = found if done is None else done.unionByName(found)
        failing = got.where(F.col("element").isNull()).select("bucket")
        if failing.isEmpty():
            return done
        buckets, level = buckets * 16, level + 1


def differences(a: DataFrame, b: DataFrame, keys: list[str], *, missing_in_a: str, missing_in_b: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(keys..., field_name) of all differences between two copies.

    field_name is missing_in_b for a key only in a, missing_in_a for one only in b, else each column, apart from the
    keys, in which the sets of values under the key differ. Columns that only one side has are left out; repeated rows
    count once; a null is a value, in keys too (null equals null only). Empty tables give each key of the other side.
    Elements are 61 bits of the whole row, so two different rows of one bucket pass for equal with a probability of
    2^-61 for each such pair.
    """
    columns = [*keys, *[c for c in a.columns if c in b.columns and c not in keys]]
    a, b = a.select(*columns), b.select(*columns)
    # Rows are hashed once, into 16 bytes each that all later steps read; only rows of differing keys are read again.
    key_hash = lambda df: row_hash([df[c] for c in keys], 2)
    narrow = lambda df, side: df.select(F.pmod(row_hash([df[c] for c in columns], 1), F.lit(PRIME)).alias("element"), key_hash(df).alias("_row_key"), F.lit(side).alias("in_a"))
    hashes = cut(narrow(a, True).unionByName(narrow(b, False)))
    rows = hashes.groupBy("in_a").count().agg(F.max("count")).first()[0] or 0
    found = differing_elements(hashes.where("in_a").select("element"), hashes.where("not in_a").select("element"), rows, bucket_rows=bucket_rows)
    wanted = cut(hashes.join(found, ["element", "in_a"], "left_semi").select("_row_key").distinct())
    fields = [c for c in columns if c not in keys]
    long = None
    for df, side in ((a, "a"), (b, "b")):
        values = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for i, c in enumerate(fields)] or [F.struct(F.lit(0).alias("i"), F.lit("").alias("field"), F.lit(None).cast("string").alias("value"))]))
        part = df.withColumn("_row_key", key_hash(df)).join(wanted, "_row_key", "left_semi").select(*keys, values.alias("_f"), F.lit(side == "a").alias("_a"))
        long = part if long is None else long.unionByName(part)
    per_field = (
        long.groupBy(*keys, "_f")
        .agg(F.max("_a").alias("_in_a"), F.max(~F.col("_a")).alias("_in_b"))
        .groupBy(*keys, F.col("_f.i").alias("_i"), F.col("_f.field").alias("_field"))
        .agg(F.max("_in_a").alias("_in_a"), F.max("_in_b").alias("_in_b"), F.max(F.col("_in_a") != F.col("_in_b")).alias("_differs"))
    )
    name = (
        F.when(~F.col("_in_b"), F.when(F.col("_i") == 0, F.lit(missing_in_b)))
        .when(~F.col("_in_a"), F.when(F.col("_i") == 0, F.lit(missing_in_a)))
        .when(F.col("_differs"), F.when(F.col("_field") != "", F.col("_field")))
    )
    return per_field.select(*keys, name.alias("field_name")).where(F.col("field_name").isNotNull())
