"""Least squares by normal equations, as Spark expressions only.

The sums behind the equations are ordinary aggregates, combined before their shuffle. What is left of a series is one small
symmetric matrix, which array expressions solve where the aggregate's result is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

# A column of the design counts as a combination of those before it if no more than this share of its square sum is left.
DEPENDENT = 1e-10


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def dot(x: Column, y: Column) -> Column:
    """Sum of the products of two arrays; the longer one's rest counts as missing, as nothing is added to it."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0)))


def moments(x: Sequence[Column], y: Column, where: Column) -> dict[str, Column]:
    """Aggregates from which `equations` builds the normal equations of y on x over the rows that ``where`` holds for."""
    full = [*x, y]
    found = {
        f"_m{i}_{j}": F.sum(F.when(where, full[i] * full[j]))
        for i in range(len(full)) for j in range(i, len(full))
    }
    return {**found, "_rows": F.count_if(where)}


def equations(width: int) -> Column:
    """Rows of the normal equations (right side last) from the columns of `moments`; the last row is that of y."""
    def at(i: int, j: int) -> Column:
        return F.coalesce(F.col(f"_m{min(i, j)}_{max(i, j)}"), F.lit(0.0))

    return F.array(*[F.array(*[at(i, j) for j in range(width + 1)]) for i in range(width + 1)])


def solve(matrix: Column, width: int) -> Column:
    """Struct (beta, used): the solution of ``width`` equations with their right sides last.

    Elimination from the first column to the last, then substitution backwards; a column that depends on those before it gets
    the coefficient 0 and does not count as used. The matrix is symmetric and has no negative eigenvalue, so no rows need to
    be exchanged.
    """
    return let(matrix, lambda m: let(F.transform(m, lambda row, i: F.get(row, i)), lambda square: _solved(m, square, width)))


def _solved(matrix: Column, square: Column, width: int) -> Column:
    start = F.struct(
        matrix.alias("left"), F.array().cast("array<array<double>>").alias("done"), F.lit(0).alias("used")
    )

    def step(state: Column, i: Column) -> Column:
        """Takes the first equation of those left; the others lose their first column."""
        def taken(top: Column) -> Column:
            pivot, behind = F.get(top, F.lit(0)), F.slice(top, 2, width)
            good = pivot > DEPENDENT * F.get(square, i)
            unit = F.when(good, let(pivot, lambda p: F.transform(behind, lambda v: v / p))).otherwise(F.transform(behind, lambda v: F.lit(0.0)))
            return let(unit, lambda u: F.struct(
                F.transform(F.slice(state["left"], 2, width), lambda row: let(F.get(row, F.lit(0)), lambda f: F.zip_with(
                    F.slice(row, 2, width), u, lambda v, w: v - f * w))).alias("left"),
                F.concat(state["done"], F.array(u)).alias("done"),
                (state["used"] + good.cast("int")).alias("used"),
            ))

        return let(F.get(state["left"], F.lit(0)), taken)

    def back(beta: Column, unit: Column) -> Column:
        return F.concat(F.array(F.element_at(unit, -1) - dot(beta, unit)), beta)

    # ``unit`` has one number more than there are coefficients yet, which `dot` adds nothing for.
    done = F.aggregate(F.sequence(F.lit(0), F.lit(width - 1)), start, step)
    return let(done, lambda d: F.struct(
        F.aggregate(F.reverse(d["done"]), F.array().cast("array<double>"), back).alias("beta"), d["used"].alias("used")
    ))
