"""What line dedup sends to the driver: tables are measured with what their arrays hold, and Spark's own estimates broadcast none."""

from pyspark.sql import functions as F

from feldspar.llm import graph, lines
from feldspar.plans.lookup import table_bytes


def test_nested_values_are_measured(spark):
    inner = F.struct(F.lit(1).alias("pos"), F.lit(2).cast("long").alias("h"), F.sequence(F.lit(1).cast("long"), F.lit(100).cast("long")).alias("cells"))
    one = spark.range(10).select("id", F.array_repeat(inner, 20).alias("at"))
    assert 10 * 20 * 100 * 8 < table_bytes(one) < 2 * 10 * 20 * 100 * 8
    flat = spark.range(10).select("id", F.sequence(F.lit(1), F.lit(5)).alias("x"), F.lit(None).cast("array<struct<s:string>>").alias("y"))
    assert table_bytes(flat) == 10 * (3 * 16 + 5 * 8)
    words = spark.range(10).select(F.array_repeat(F.lit("x" * 1000), 3).alias("w"))
    assert table_bytes(words) > 10 * 3000


def test_no_table_is_broadcast_by_an_estimate(spark, monkeypatch, capsys):
    names = ("feldspar.llm.lines", "feldspar.llm.graph")
    plans = []

    def seen(real):
        def run(df):
            df.explain()
            plans.append(capsys.readouterr().out)
            return real(df)

        return run

    for module, name in zip((lines, graph), names):
        monkeypatch.setattr(module, "materialize", seen(module.materialize))
    monkeypatch.setattr(lines, "SENT_BYTES", 0)
    text = [f"the {i // 3} lines of this text are mostly like each other, number {i // 3} and sign {'xyz'[i % 3]}\nend" for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    out = lines.dedup(docs)
    out.explain()
    plans.append(capsys.readouterr().out)
    assert len(plans) > 8 and not any("Broadcast" in p for p in plans)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before
    assert out.agg(F.sum("n_dropped")).first()[0] >= 29
