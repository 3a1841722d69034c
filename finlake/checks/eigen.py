"""Oracle SQL of principal components: covariances, then eigenvectors by repeated squaring, one after the other."""

from __future__ import annotations


def components(rows: str, k: int, squarings: int = 12) -> str:
    """CTEs that end in pcs(p, date, i, pc, share).

    ``rows`` is a query of (p, date, i, x): for each part p, the values of column i on the dates that its fit sees.  Missing values
    count as their column's mean.  The matrix is squared until only the first component is left in it; that one is taken out of the
    matrix before the next is sought.
    """
    out = [f"long AS MATERIALIZED ({rows})",
           "st AS (SELECT p, i, coalesce(avg(x), 0) AS m, coalesce(stddev_pop(x) * sqrt(count(x) / count(*)), 0) AS s FROM long GROUP BY p, i)",
           "z AS MATERIALIZED (SELECT p, date, i, coalesce(x - m, 0) / CASE WHEN s > 1e-14 * greatest(1, abs(m)) THEN s ELSE 1 END AS z FROM long JOIN st USING (p, i))",
           "c1 AS MATERIALIZED (SELECT a.p, a.i, b.i AS j, sum(a.z * b.z) / count(*) AS v FROM z a JOIN z b ON a.p = b.p AND a.date = b.date GROUP BY a.p, a.i, b.i)",
           "trace AS (SELECT p, sum(v) AS t FROM c1 WHERE i = j GROUP BY p)"]
    for n in range(1, k + 1):
        before = f"c{n}"
        for s in range(1, squarings + 1):
            out.append(f"q{n}_{s} AS MATERIALIZED (SELECT a.p, a.i, b.j, sum(a.v * b.v) AS v FROM {before} a JOIN {before} b ON a.p = b.p AND a.j = b.i GROUP BY a.p, a.i, b.j)")
            before = f"s{n}_{s}"
            out.append(f"{before} AS MATERIALIZED (SELECT p, i, j, v / nullif(t, 0) AS v FROM q{n}_{s} JOIN (SELECT p, sum(v) AS t FROM q{n}_{s} WHERE i = j GROUP BY p) USING (p))")
        out += [f"b{n} AS (SELECT p, arg_max(j, v) AS j, max(v) AS v FROM {before} WHERE i = j GROUP BY p)",
                f"v{n} AS MATERIALIZED (SELECT x.p, x.i, x.v / sqrt(b{n}.v) AS v FROM {before} x JOIN b{n} ON x.p = b{n}.p AND x.j = b{n}.j)",
                f"l{n} AS MATERIALIZED (SELECT c.p, sum(a.v * c.v * b.v) AS l FROM c{n} c JOIN v{n} a ON a.p = c.p AND a.i = c.i JOIN v{n} b ON b.p = c.p AND b.i = c.j GROUP BY c.p)",
                f"c{n + 1} AS MATERIALIZED (SELECT c.p, c.i, c.j, c.v - l * a.v * b.v AS v FROM c{n} c JOIN l{n} USING (p) JOIN v{n} a ON a.p = c.p AND a.i = c.i JOIN v{n} b ON b.p = c.p AND b.i = c.j)"]
    every = " UNION ALL ".join(f"SELECT z.p, z.date, {n} AS i, abs(sum(z.z * v.v)) AS pc, any_value(l / t) AS share FROM z JOIN v{n} v ON v.p = z.p AND v.i = z.i JOIN l{n} ON l{n}.p = z.p JOIN trace ON trace.p = z.p GROUP BY z.p, z.date" for n in range(1, k + 1))
    return ",\n    ".join([*out, f"pcs AS ({every})"])


def unpivot(table: str, cols: list[str], p: str = "0", where: str = "TRUE") -> str:
    """(p, date, i, x) of the listed columns of a table."""
    return " UNION ALL ".join(f"SELECT {p} AS p, date, {i} AS i, CAST({c} AS DOUBLE) AS x FROM {table} WHERE {where}" for i, c in enumerate(cols))
