from pyspark.sql import functions as F


def documents(spark, rows, extra=()):
    """A documents table of (doc_id, text) rows, with further columns of the given names."""
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df = df.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})
    return df.withColumns({name: F.lit("clash") for name in extra})
