"""Queries on grids of cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grid
from .q_match import OFF, near, refine
from .registry import query
from .standins import DENSE_REFERENCE, REFERENCE, STARS


def cells_sql(reference: str, grids, tag: str = "") -> str:
    """CTEs ``cells`` (grid, tile, i, j, ...) of all grids."""
    out = f"a AS ({STARS.sql}), b AS ({reference}), box AS (SELECT tile, min(ra) AS r0, max(ra) AS r1, min(dec) AS d0, max(dec) AS d1 FROM a GROUP BY tile)"
    for n, least, floor in grids:
        span = lambda t, m: f"""(SELECT t.tile * 1000 + g.i * 10 + g.j AS cell, t.tile AS t, t.id, t.ra, t.dec FROM {t} t JOIN box USING (tile), (SELECT u1.i, u2.j FROM range({n}) u1(i), range({n}) u2(j)) g
  WHERE ra BETWEEN r0 + (r1 - r0) / {n} * g.i - {m} AND r0 + (r1 - r0) / {n} * (g.i + 1) + {m} AND dec BETWEEN d0 + (d1 - d0) / {n} * g.j - {m} AND d0 + (d1 - d0) / {n} * (g.j + 1) + {m})"""  # noqa: E731
        out += f""", ca{n} AS {span('a', 0)}, cb{n} AS {span('b', 2.0 / 3600)},
na{n} AS (SELECT cell, count(*) AS n FROM ca{n} GROUP BY cell HAVING count(*) >= {least}), z{n} AS (SELECT cell, n, coalesce(m, 0) AS n_ref FROM na{n} LEFT JOIN (SELECT cell, count(*) AS m FROM cb{n} GROUP BY cell) USING (cell)),
pa{n} AS (SELECT * FROM ca{n} WHERE cell IN (SELECT cell FROM z{n} WHERE n_ref >= {least})), pb{n} AS (SELECT * FROM cb{n} WHERE cell IN (SELECT cell FROM z{n} WHERE n_ref >= {least})),
{near(f'pa{n}', f'pb{n}', 2.5, 'cell', f'pairs{n}')}, off_{n} AS ({OFF.format(keys='cell', pairs=f'pairs{n}')}), {refine('cell', 2.5, name=f'_{n}')},
cells{n} AS (SELECT {n} AS grid, cell, n, n_ref, cx * 1000 AS dra, cy * 1000 AS ddec, npairs, top / background AS ratio,
  CASE WHEN n_ref < {least} THEN 'too few reference stars' WHEN NOT coalesce(npairs >= 30 AND npairs >= {least} AND top / background >= {floor}, false) THEN 'no clear peak' END AS reason FROM z{n} LEFT JOIN c_{n}4 USING (cell))"""
    return out + ", cells AS (" + " UNION ALL ".join(f"SELECT * FROM cells{n}" for n, _, _ in grids) + ")"


SHOW = """SELECT cell // 1000 AS tile, cell // 10 % 100 AS i, cell % 10 AS j, n, n_ref, CASE WHEN reason IS NULL THEN round(dra, 5) END AS dra, CASE WHEN reason IS NULL THEN round(ddec, 5) END AS ddec, CASE WHEN reason IS NULL THEN round(ratio, 5) END AS peak_ratio, CASE WHEN reason IS NULL THEN npairs END AS npairs, reason"""


def shown(x, *more):
    return x.select("tile", "i", "j", "n", "n_ref", *[F.round(c, 5).alias(c) for c in ("dra", "ddec", "peak_ratio")], "npairs", "reason", *more)


@query("cell_offsets", f"WITH {cells_sql(DENSE_REFERENCE.sql, grid.GRIDS[:1])} {SHOW} FROM cells")
def cell_offsets(spark, d):
    return shown(grid.cell_offsets(STARS.df(spark, d), DENSE_REFERENCE.df(spark, d), ["tile"], *grid.GRIDS[0]))


BEST = "best AS (SELECT cell // 1000 AS tile, max(grid) AS grid FROM cells WHERE reason IS NULL GROUP BY 1)"


@query(
    "adaptive_grid",
    f"WITH {cells_sql(REFERENCE.sql, grid.GRIDS)}, {BEST} {SHOW}, coalesce(b.grid, 0) AS grid FROM cells c LEFT JOIN best b ON b.tile = c.cell // 1000 WHERE c.grid = coalesce(b.grid, 1)",
)
def adaptive_grid(spark, d):
    return shown(grid.adaptive_grid(STARS.df(spark, d), REFERENCE.df(spark, d), ["tile"]), "grid")


@query("cell_consistency")
def cell_consistency(spark, d):
    x = grid.consistency(grid.adaptive_grid(STARS.df(spark, d), DENSE_REFERENCE.df(spark, d), ["tile"]), ["tile"])
    return x.select("tile", *[F.round(c, 4).alias(c) for c in ("dra", "ddec", "off", "spread", "bad_fraction", "coverage")], "n_cells", "n_dropped", "n_deviating", "n_confirmed", "n_spurious", "consistent")


def made_cells(spark, d):
    """Cells from counts and rounded means of stars, to show the rules apart from the histogram."""
    a = STARS.df(spark, d)
    x = a.groupBy("field", (F.col("detector") % 4).cast("bigint").alias("i"), (F.col("cust") % 4).alias("j")).agg(F.count(F.lit(1)).alias("n"), F.max(F.col("cust") % 11).cast("double").alias("m"))
    high = F.when((F.col("i") == 0) & (F.col("j") <= 1), 60.0).when((F.col("i") == 3) & (F.col("j") == 3), 90.0).otherwise(0.0)
    reason = F.when((F.col("i") == 1) & (F.col("field") == "5-LOW"), "no clear peak")
    return x.select("field", "i", "j", "n", (F.col("m") + high).alias("dra"), (F.col("i") - F.col("j")).cast("double").alias("ddec"), reason.alias("reason"))


WM = "(SELECT field, min({v}) AS m{v} FROM (SELECT field, {v}, sum(n) OVER (PARTITION BY field ORDER BY {v}) AS c, sum(n) OVER (PARTITION BY field) AS t FROM c WHERE reason IS NULL) WHERE c >= t / 2 GROUP BY field)"


@query(
    "cell_rules",
    f"""WITH a AS ({STARS.sql}), q AS (SELECT field, detector % 4 AS i, cust % 4 AS j, count(*) AS n, max(cust % 11)::DOUBLE AS m FROM a GROUP BY ALL),
c AS (SELECT field, i, j, n, m + CASE WHEN i = 0 AND j <= 1 THEN 60 WHEN i = 3 AND j = 3 THEN 90 ELSE 0 END AS dra, (i - j)::DOUBLE AS ddec, CASE WHEN i = 1 AND field = '5-LOW' THEN 'no clear peak' END AS reason FROM q),
k AS (SELECT c.*, mdra, mddec, sqrt((dra - mdra) * (dra - mdra) + (ddec - mddec) * (ddec - mddec)) > 30 AS dev FROM c JOIN {WM.format(v='dra')} USING (field) JOIN {WM.format(v='ddec')} USING (field) WHERE reason IS NULL),
f AS (SELECT *, dev AND EXISTS (SELECT 1 FROM k o WHERE o.field = k.field AND o.dev AND abs(o.i - k.i) + abs(o.j - k.j) = 1) AS conf FROM k),
s AS (SELECT field, any_value(mdra) AS dra, any_value(mddec) AS ddec, count(*) AS n_cells, count(*) FILTER (dev) AS n_deviating, count(*) FILTER (conf) AS n_confirmed, sum(n) AS nn, coalesce(sum(n) FILTER (conf), 0) AS bad FROM f GROUP BY field),
l AS (SELECT field, sum(n) AS lost FROM c WHERE reason IS NOT NULL GROUP BY field)
SELECT field, dra, ddec, n_cells, n_deviating, n_confirmed, round(bad / nn, 6) AS bad_fraction, round(nn / (nn + coalesce(lost, 0)), 6) AS coverage, n_cells >= 4 AND bad / nn < {grid.BAD_SHARE} AND nn / (nn + coalesce(lost, 0)) >= 0.5 AS consistent FROM s LEFT JOIN l USING (field)""",
)
def cell_rules(spark, d):
    x = grid.consistency(made_cells(spark, d), ["field"])
    return x.select("field", "dra", "ddec", "n_cells", "n_deviating", "n_confirmed", F.round("bad_fraction", 6).alias("bad_fraction"), F.round("coverage", 6).alias("coverage"), "consistent")
