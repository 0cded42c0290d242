"""Queries of the image kernels on planes of 8 x 8, a row for each pixel, with their SQL; and the nearest pair."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tessella.functions import kernels as k
from tessella.operators import geometry, provenance, segment
from tessella.plans.queries import query, rounded
from tessella.plans.stand_ins import PX, line_tasks, table

CUT = 0.05
MASK_SQL = f"{PX}, mk AS (SELECT image_id, x, y, v, v >= {CUT} AS m FROM px), o AS (SELECT dx, dy FROM range(-1, 2) a(dx), range(-1, 2) b(dy) WHERE dx * dx + dy * dy <= 1), o8 AS (SELECT dx, dy FROM range(-1, 2) a(dx), range(-1, 2) b(dy))"


def near(source: str, what: str, offsets: str = "o") -> str:
    """An aggregate over each pixel's neighbours in the image."""
    return f"SELECT a.image_id, a.x, a.y, first(a.v) AS v, {what} AS m FROM {source} a, {offsets}, {source} b WHERE b.image_id = a.image_id AND b.x = a.x + dx AND b.y = a.y + dy GROUP BY 1, 2, 3"


def applied(spark, d, kernel: Callable):
    """(image_id, x, y, v): the kernel's result on every embedding as a plane."""

    def run(frames):
        y, x = np.divmod(np.arange(64), 8)
        for frame in frames:
            out = [np.asarray(kernel(np.asarray(e, dtype="<f4").astype(float).reshape(8, 8)), dtype=float).ravel() for e in frame["embedding"]]
            if out:
                yield pd.DataFrame({"image_id": np.repeat(frame["vec_id"].to_numpy(), 64), "x": np.tile(x, len(out)), "y": np.tile(y, len(out)), "v": np.concatenate(out)})

    return rounded(table(spark, d, "embeddings").select("vec_id", "embedding").mapInPandas(run, "image_id long, x long, y long, v double"))


@query(f"WITH {PX}, w AS (SELECT i, exp(-0.5 * i * i) / sum(exp(-0.5 * i * i)) OVER () AS g FROM range(-4, 5) t(i)) SELECT a.image_id, a.x, a.y, round(sum(wx.g * wy.g * b.v), 6) AS v FROM px a, w wx, w wy, px b WHERE b.image_id = a.image_id AND b.x = greatest(0, least(7, a.x + wx.i)) AND b.y = greatest(0, least(7, a.y + wy.i)) GROUP BY 1, 2, 3")
def plane_blur(spark, d):
    return applied(spark, d, lambda a: k.gaussian(a, 1.0))


@query(f"WITH {MASK_SQL}, di AS ({near('mk', 'bool_or(b.m)')}), er AS ({near('di', 'bool_and(b.m)')}) SELECT image_id, x, y, CASE WHEN m THEN 1.0::DOUBLE ELSE 0.0 END AS v FROM er")
def plane_closing(spark, d):
    return applied(spark, d, lambda a: k.closing(a >= CUT, k.disc(1)))


@query(f"WITH {MASK_SQL}, er AS ({near('mk', 'min(b.v)')}), e2 AS (SELECT image_id, x, y, m AS v FROM er), di AS ({near('e2', 'max(b.v)')}) SELECT px.image_id, px.x, px.y, round(greatest(px.v - m, 0), 6) AS v FROM px JOIN di USING (image_id, x, y)")
def plane_top_hat(spark, d):
    return applied(spark, d, lambda a: np.maximum(a - k.opening(a, k.disc(1)), 0))


@query(f"WITH {MASK_SQL} SELECT a.image_id, a.x, a.y, round(CASE WHEN first(a.m) THEN min(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) FILTER (NOT b.m) ELSE 0 END, 6) AS v FROM mk a JOIN mk b USING (image_id) GROUP BY 1, 2, 3")
def plane_distance(spark, d):
    return applied(spark, d, lambda a: k.distance(a >= CUT))


@query(f"WITH RECURSIVE {MASK_SQL}, rc AS (SELECT image_id, x, y, y * 8 + x AS root FROM mk WHERE m UNION SELECT b.image_id, b.x, b.y, rc.root FROM rc, o8, mk b WHERE b.image_id = rc.image_id AND b.x = rc.x + dx AND b.y = rc.y + dy AND b.m), r AS (SELECT image_id, x, y, min(root) AS root FROM rc GROUP BY 1, 2, 3), l AS (SELECT image_id, x, y, dense_rank() OVER (PARTITION BY image_id ORDER BY root) AS n FROM r) SELECT mk.image_id, mk.x, mk.y, coalesce(n, 0)::DOUBLE AS v FROM mk LEFT JOIN l USING (image_id, x, y)")
def plane_components(spark, d):
    return applied(spark, d, lambda a: k.components(a >= CUT))


@query(f"WITH RECURSIVE {MASK_SQL}, ou AS (SELECT image_id, x, y FROM mk WHERE NOT m AND (x IN (0, 7) OR y IN (0, 7)) UNION SELECT b.image_id, b.x, b.y FROM ou, o, mk b WHERE b.image_id = ou.image_id AND b.x = ou.x + dx AND b.y = ou.y + dy AND NOT b.m) SELECT mk.image_id, mk.x, mk.y, CASE WHEN ou.image_id IS NULL THEN 1.0::DOUBLE ELSE 0.0 END AS v FROM mk LEFT JOIN ou USING (image_id, x, y)")
def plane_fill_holes(spark, d):
    return applied(spark, d, lambda a: k.fill_holes(a >= CUT))


@query(f"""WITH RECURSIVE {PX}, o8 AS (SELECT dx, dy FROM range(-1, 2) a(dx), range(-1, 2) b(dy)), co AS (SELECT image_id, x, y, CAST(floor((v + 0.5) * 8) AS BIGINT) + 256 * (x // 4) AS code FROM px),
n AS (SELECT image_id, code, count(*) AS n FROM co GROUP BY 1, 2), bg AS (SELECT image_id, arg_max(code, n * 1000000 - code) AS background FROM n GROUP BY 1), ob AS (SELECT co.* FROM co JOIN bg USING (image_id) WHERE code <> background),
rc AS (SELECT image_id, x, y, code, y * 8 + x AS root FROM ob UNION SELECT b.image_id, b.x, b.y, b.code, rc.root FROM rc, o8, ob b WHERE b.image_id = rc.image_id AND b.x = rc.x + dx AND b.y = rc.y + dy AND b.code = rc.code),
r AS (SELECT image_id, x, y, code, min(root) AS root FROM rc GROUP BY 1, 2, 3, 4), l AS (SELECT image_id, x, y, dense_rank() OVER (PARTITION BY image_id ORDER BY code, root) AS n FROM r) SELECT co.image_id, co.x, co.y, coalesce(l.n, 0)::DOUBLE AS v FROM co LEFT JOIN l USING (image_id, x, y)""")
def plane_instances(spark, d):
    columns = 256 * (np.arange(8) // 4)
    return applied(spark, d, lambda a: segment.decode_instances(np.floor((a + 0.5) * 8).astype(np.int64) + columns))


NUCLEI_SQL = "nu AS (SELECT l_orderkey // 8 AS image_id, row_number() OVER (PARTITION BY l_orderkey // 8 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS id, (l_partkey % 997)::DOUBLE AS cx, (l_extendedprice % 991)::DOUBLE AS cy, sqrt(l_quantity) / 2 AS r FROM lineitem)"


@query(f"WITH {NUCLEI_SQL}, g AS (SELECT a.image_id, min(sqrt((a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2) - a.r - b.r) AS smallest_gap FROM nu a JOIN nu b ON a.image_id = b.image_id AND a.id < b.id GROUP BY 1) SELECT image_id, count(*) AS n_nuclei, round(first(smallest_gap), 6) AS smallest_gap FROM nu LEFT JOIN g USING (image_id) GROUP BY 1")
def smallest_gap(spark, d):
    image = F.floor(F.col("l_orderkey") / 8)
    lines = table(spark, d, "lineitem")
    nuclei = lines.select(image.alias("image_id"), (F.col("l_partkey") % 997).cast("double").alias("cx"), (F.col("l_extendedprice") % 991).alias("cy"), (F.sqrt("l_quantity") / 2).alias("radius"))
    return rounded(geometry.smallest_gap(nuclei, line_tasks(spark, lines)))


@query("""WITH l AS (SELECT source || '/' || doc_id || '.txt' AS path, sha256(coalesce(text, '')) AS d FROM documents WHERE doc_id % 13 <> 0), f AS (SELECT source || '/' || doc_id || '.txt' AS path, sha256(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)) || CASE WHEN doc_id % 7 = 0 THEN '!' ELSE '' END) AS d FROM documents WHERE doc_id % 11 <> 0)
SELECT path, CASE WHEN f.d IS NULL THEN 'MISSING' WHEN l.d IS NULL THEN 'UNLISTED' WHEN l.d = f.d THEN 'OK' ELSE 'CHANGED' END AS status FROM l FULL JOIN f USING (path)""")
def digest_comparison(spark, d):
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, d, "documents").select("doc_id", F.concat("source", F.lit("/"), "doc_id", F.lit(".txt")).alias("path"), text.alias("text"))
    rows = docs.select("*", F.concat("text", F.when(F.col("doc_id") % 7 == 0, "!").otherwise("")).cast("binary").alias("after"), F.col("text").cast("binary").alias("before"))
    listed = rows.where("doc_id % 13 <> 0").select("path", F.sha2("before", 256).alias("digest"))
    found = rows.where("doc_id % 11 <> 0").select("path", provenance.digest("after", "path").alias("digest"))
    return provenance.compare(listed, found)
