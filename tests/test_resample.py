"""Resampling of several images in one job."""

from pyspark.sql import functions as F

from skyledger.operators import pixels


def test_each_image_is_resampled_from_its_own_pixels(spark):
    rows = [(i, y, x, float(1000 * i + 10 * y + x)) for i in (0, 1, 2) for y in range(6) for x in range(6) if (i, y, x) != (1, 3, 3)]
    df = spark.createDataFrame(rows, "image long, y long, x long, value double").withColumn("dq", F.lit(0))
    got = pixels.resample(df, df.select("image", "y", "x"), (F.col("x") + 0.5, F.col("y") + 0.25), ["image"])
    value = {(r.image, r.y, r.x): r.value for r in got.collect()}
    have = {(i, y, x): v for i, y, x, v in rows}
    assert set(value) == set(have)
    for i, y, x in have:
        near = [(w, have.get((i, y + j, x + k))) for j, k, w in ((0, 0, 0.375), (0, 1, 0.375), (1, 0, 0.125), (1, 1, 0.125))]
        want = None if any(v is None for _, v in near) else sum(w * v for w, v in near)
        assert value[i, y, x] == want
