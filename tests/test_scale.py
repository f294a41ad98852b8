"""Plans and skew: what must hold when tables are large and keys are hot."""

import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from florin import params
from florin.operators import channels, deposits, facts, market, movements, refunds, securities
from florin.operators.facts import of_window, per_report_date
from florin.operators.report_dates import business_day_span, listed_span, on_dates, window_span
from florin.plans import daily
from florin.plans.registry import QUERIES
from florin.sources.catalog import CONTRACTS, from_frames, from_paths, from_tables
from florin.sources.samples import sample_sources
from tiny import one, schema_of, span_of

SF_DIR = "/root/testdata/sf0.001"
DAY = date(2024, 1, 10)


def plan_of(df, mode="executedPlan"):
    return getattr(df._jdf.queryExecution(), mode)().toString()


def sources_with(spark, **frames):
    empty = {n: spark.createDataFrame([], schema_of(n)) for n in CONTRACTS}
    return from_frames(spark, {**empty, **frames})


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_multiplies_rows_or_leaves_the_jvm(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "FlatMapGroups", "Window ["):
        assert operator not in plan


def test_no_unhinted_source_is_broadcast_when_statistics_say_it_is_large(spark):
    """With Spark's size check failing, the bounded date bridge, what belongs to its dates, and held lists are still broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        span = window_span(spark, date(2024, 1, 12))
        plan = plan_of(daily.statements(daily.daily_metrics(span, sample_sources(spark, SF_DIR))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    bounded = ("source_date", "agreed_on", "_channel", "third_code", "codigo_contable", "cuenta_bancaria", "id_cuenta")
    assert joins and all(any(name in line for name in bounded) for line in joins)
    assert "SortMergeJoin" in plan


def test_report_reads_each_source_once(spark):
    """Lists are read before the plan; unity operations and the adapter feed two joins each."""
    span = window_span(spark, date(2024, 1, 12))
    src = sample_sources(spark, SF_DIR)
    plan = plan_of(daily.statements(daily.daily_metrics(span, src)))
    assert plan.count("FileScan parquet") <= 16


def test_plan_does_not_grow_with_the_number_of_dates(spark):
    src = sample_sources(spark, SF_DIR)

    def scans(span):
        plan = plan_of(daily.cash_summary(daily.statements(daily.daily_metrics(span, src))))
        return plan.count("FileScan"), plan.count("Exchange hashpartitioning")

    short = scans(window_span(spark, date(2024, 1, 12)))
    decade = scans(business_day_span(spark, date(2014, 1, 1), date(2024, 1, 31)))
    assert short[0] == decade[0] and abs(short[1] - decade[1]) <= 2


def test_partitions_and_columns_are_pruned(spark, tmp_path):
    path = tmp_path / "renewals"
    days = spark.range(400).select(
        F.col("id").cast("double").alias("total_renovacion"),
        F.lit("unused").alias("nota"),
        F.date_add(F.lit(date(2023, 6, 1)), F.col("id").cast("int")).alias("fecha_operacion"),
    )
    days.repartition(1).write.partitionBy("fecha_operacion").parquet(str(path))
    src = from_paths(spark, str(tmp_path))
    plan = plan_of(securities.cdt_renewals(span_of(spark, DAY), src))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert re.search(r"PartitionFilters: \[isnotnull\(fecha_operacion#\d+\), \(fecha_operacion#\d+ = 2024-01-10\)\]", scan)
    assert "ReadSchema: struct<total_renovacion:double>" in scan
    assert "BroadcastHashJoin" in plan


def test_date_bounds_reach_the_row_groups(spark, tmp_path):
    spark.createDataFrame([(1.0, DAY)], "total_renovacion double, fecha_operacion date").write.parquet(
        str(tmp_path / "renewals")
    )
    plan = plan_of(securities.cdt_renewals(span_of(spark, DAY), from_paths(spark, str(tmp_path))))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "EqualTo(fecha_operacion,2024-01-10)" in scan


def test_long_spans_prune_by_range(spark, tmp_path):
    days = spark.range(10).select(
        F.lit(1.0).alias("total_renovacion"),
        F.date_add(F.lit(date(2023, 6, 1)), F.col("id").cast("int")).alias("fecha_operacion"),
    )
    days.write.partitionBy("fecha_operacion").parquet(str(tmp_path / "renewals"))
    src = from_paths(spark, str(tmp_path))
    for first, mark in ((date(2020, 1, 1), ">= 2020-01-02"), (date(1900, 1, 1), ">= 1899-12-17")):
        span = business_day_span(spark, first, date(2024, 1, 1))
        result = securities.cdt_renewals(span, src)
        scan = next(line for line in plan_of(result).splitlines() if "FileScan" in line)
        assert mark in scan
        assert result.where("renewals > 0").count() == 7


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    """Movements and operations bucketed by operation number: only the final totals are exchanged."""
    keys = {"cc_movements": "operacion", "unity_operations": "consecutivo"}
    sample = sample_sources(spark, "/root/testdata/sf0.01")
    span = window_span(spark, date(2024, 1, 12))
    expected = {tuple(r) for r in movements.concept_derivation(span, sample).collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20KB")  # the concept master, not more
    try:
        plain = plan_of(movements.concept_derivation(span, sample))
        for table, key in keys.items():
            writer = sample[table].write.bucketBy(4, key).sortBy(key).mode("overwrite")
            writer.option("path", str(tmp_path / table)).saveAsTable(f"florin_{table}")
        names = {table: f"florin_{table}" for table in keys}
        frames = {**{n: sample[n] for n in CONTRACTS}, **{n: from_tables(spark, names)[n] for n in keys}}
        result = movements.concept_derivation(span, from_frames(spark, frames))
        bucketed = plan_of(result)
        assert {tuple(r) for r in result.collect()} == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for table in keys:
            spark.sql(f"DROP TABLE IF EXISTS florin_{table}")
    on_operation = re.compile(r"Exchange hashpartitioning\((operacion|consecutivo)")
    assert len(on_operation.findall(plain)) >= 3 and not on_operation.findall(bucketed)


def test_missing_columns_are_reported(spark):
    src = from_frames(spark, {"trm": spark.range(1)})
    with pytest.raises(ValueError, match="trm lacks columns"):
        src["trm"]


# --- hot keys: equal results by row-level joins, and small shuffles ----------------------

N = 30_000


def repeated(spark, hot_share=3):
    """N rows, a third of them on key 0."""
    return spark.range(N).withColumn("key", F.when(F.col("id") % hot_share == 0, 0).otherwise(F.col("id")))


def shuffled_rows(df):
    """Rows written by the shuffles of an executed query, largest first."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if name.startswith("ShuffleQueryStage") or name == "Exchange":
            plan = node.plan() if name.startswith("ShuffleQueryStage") else node
            metrics = plan.metrics()
            if metrics.contains("shuffleRecordsWritten"):
                found.append(metrics.apply("shuffleRecordsWritten").value())
            return walk_children(plan)
        if name.startswith(("BroadcastQueryStage", "ResultQueryStage")):
            return walk(node.plan())
        return walk_children(node)

    def walk_children(node):
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sorted(found, reverse=True)


def test_hot_operation_on_both_sides_of_the_market_join(spark):
    trades = repeated(spark).select(
        F.lit(0).cast("long").alias("consecutivo"),
        F.lit(DAY - timedelta(days=1)).alias("fecha_operacion"),
        F.lit(DAY).alias("fecha_cumplimiento"),
        *[
            F.lit(v).alias(c)
            for c, v in {
                "cod_central_deposito": "DCV",
                "clasificacion": "NORMAL",
                "tipo_sim": "A",
                "codigo_especie": "CT",
                "nemotecnico": "TFIT",
                "tipo_operacion": "V",
                "genera_detalle": "SI",
            }.items()
        ],
        F.lit(1.0).alias("valor_de_giro"),
    )
    control = spark.range(N).select(F.lit(0).cast("long").alias("consecutivo"), F.lit(DAY).alias("fecha_cuadre"))
    operations = control.withColumns(
        {c: F.lit(None).cast("string") for c in ("clasificacion", "liquidacion", "tipo_operacion")}
    ).withColumn("fecha_futura", F.lit(None).cast("date"))
    src = sources_with(spark, money_market=trades, unity_operations=operations)
    # A row-level join would build N * N = 900 million rows.
    result = market.money_market_settlement(span_of(spark, DAY), src)
    assert one(result)["sell_tes"] == float(N) * N
    assert max(shuffled_rows(result)) < 100


def test_hot_account_in_channel_transactions(spark):
    transactions = repeated(spark).select(
        F.col("key").alias("clave_cuenta_padre"),
        F.lit(1).cast("long").alias("clave_canal"),
        F.lit(-1.0).alias("monto"),
        F.lit(datetime(2024, 1, 10, 9)).alias("fecha_hora_valor"),
        F.lit(DAY).alias("fecha_valor"),
    )
    versions = repeated(spark).select(
        F.col("key").alias("clave_codificada"),
        F.lit(params.CREDIT_ACCOUNT).alias("id"),
        F.lit(datetime(2023, 1, 1)).alias("fecha_ultima_modificacion"),
        F.col("id").alias("version"),
    )
    names = spark.createDataFrame([(1, params.ACH_WITHDRAWAL)], "clave_codificada long, nombre string")
    src = sources_with(spark, transactions=transactions, accounts=versions, channels=names)
    span = span_of(spark, DAY)
    assert one(channels.ach_time_slots(span, src))["ret_1"] == N
    assert one(channels.credit_confirming(span, src))["credit_outcome"] == N
    totals = one(channels.scan_totals(span, src))
    assert (totals["n_rows"], totals["total"]) == (N, -N)


def movements_with_a_hot_operation(spark):
    """A third of the movements hang on one operation, with distinct amounts; another third on none."""
    rows = spark.range(N)
    moves = rows.select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.col("id")).alias("operacion"),
        F.lit(None).cast("string").alias("concepto"),
        (F.col("id") + 1).cast("double").alias("valor"),
        F.lit("NC").alias("cod_tipo_movimiento"),
        F.lit(DAY).alias("fecha"),
        F.lit("1").alias("cuenta_bancaria"),
        F.lit(None).cast("double").alias("rendimiento"),
    )
    operations = rows.where("id % 3 < 2").select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("consecutivo"),
        F.lit(DAY).alias("fecha_cuadre"),
        F.lit("TTV").alias("clasificacion"),
        F.lit(None).cast("string").alias("liquidacion"),
        F.lit(None).cast("string").alias("tipo_operacion"),
        F.lit(None).cast("date").alias("fecha_futura"),
    )
    third = spark.createDataFrame(
        [(params.CODE_TTV, "h", params.THIRD_PARTY_CONCEPT)],
        "codigo_contable string, codigo_cud string, concepto_cud string",
    )
    return sources_with(spark, cc_movements=moves, unity_operations=operations, homologation=third)


def test_hot_operation_in_movements(spark):
    src, span = movements_with_a_hot_operation(spark), span_of(spark, DAY)
    credits = spark.range(0, N, 2).select(
        F.lit(DAY).alias("report_date"), (F.col("id") + 1).cast("decimal(18,4)").alias("amount")
    )
    facts = movements.movement_facts(span, src, credits)
    row = one(per_report_date(span, facts, movements.THIRD_METRICS))
    hot = sum(i + 1 for i in range(0, N, 3) if i % 2) * (N // 3)  # the hot operation exists N/3 times
    cold = sum(i + 1 for i in range(1, N, 3) if i % 2)
    assert row["third_in"] == float(hot + cold)
    rows = movements.concept_derivation(span, src).collect()
    assert {r.concepto: r.n_rows for r in rows} == {None: N // 3, params.CODE_TTV: (N // 3) ** 2 + N // 3}


def test_a_hot_operation_with_distinct_amounts_is_split_over_tasks(spark):
    """The one join whose rows cannot all be summed first: adaptive execution may split it."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        result = movements.concept_derivation(span_of(spark, DAY), movements_with_a_hot_operation(spark))
        assert sum(r.n_rows for r in result.collect()) == (N // 3) ** 2 + 2 * (N // 3)
        assert "skew=true" in plan_of(result)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_hot_refund_group_and_hot_statement_account(spark):
    rows = spark.range(N)
    adapter = rows.select(
        F.when(F.col("id") % 3 == 0, params.SENT_REFUND).otherwise("_ach_out").alias("transaction_type"),
        F.when(F.col("id") % 3 == 0, "x").otherwise("a.4.OUT").alias("name"),
        F.lit(params.UNAUTHORIZED).alias("status"),
        F.lit("C").alias("reg6_cuenta_receptora"),
        F.lit("E").alias("reg6_entidad_receptora"),
        F.lit("E").alias("reg5_entidad_originadora"),
        F.lit("O").alias("reg5_nombre_originador"),
        F.lit("N").alias("reg6_nombre_cliente_receptor"),
        F.lit("100").alias("reg6_valor_transaccion"),
        F.lit(None).cast("string").alias("reg5_datos_originador"),
        F.lit(DAY).alias("fecha_consulta"),
    )
    statements = rows.select(
        F.lit("777").alias("cuenta_bancaria"),
        F.lit("COP").alias("moneda"),
        F.lit(1.0).alias("monto"),
        F.lit(DAY).alias("fecha_mvto"),
    )
    own = spark.createDataFrame(
        [("0777", params.HOLDER, params.ACTIVE)] * 2, "cuenta_bancaria string, titular string, estado string"
    )
    src = sources_with(spark, adapter=adapter, multicash=statements, umbrella=own)
    span = span_of(spark, DAY)
    matched = refunds.ach_refunds(span, src)
    assert one(matched)["send_4"] == N // 3
    assert max(shuffled_rows(matched)) < 200
    totals = deposits.bank_transaction_totals(span, src)
    assert one(totals)["cop_in"] == 2 * N
    assert max(shuffled_rows(totals)) < 100


def test_bridge_serves_overlapping_intervals(spark):
    source = spark.createDataFrame([(date(2024, 1, 6), 1.0)], "fecha date, valor double")
    span = span_of(spark, date(2024, 1, 6), date(2024, 1, 9))
    rows = on_dates(source, "fecha", span, ["movements"]).collect()
    assert sorted(r.report_date.day for r in rows) == [6, 9]


# A column that only the history has, and a result that needs it.
HISTORIES = {
    "valor_de_giro": market.scan_totals,
    "clasificacion": movements.concept_derivation,
    "fecha_ultima_modificacion": channels.ach_time_slots,
    "nombre_inversion": securities.scan_totals,
}


@pytest.mark.parametrize("column", sorted(HISTORIES))
def test_a_large_history_is_sorted_out_where_it_is_read(spark, monkeypatch, tmp_path, column):
    """Keys that no report date has are gone before the history's first sum and shuffle."""
    sample = sample_sources(spark, SF_DIR)
    for name in CONTRACTS:
        sample[name].write.parquet(str(tmp_path / name))
    src, span = from_paths(spark, str(tmp_path)), window_span(spark, date(2024, 1, 12))
    build = HISTORIES[column]
    whole = build(span, src)
    expected = sorted(map(repr, whole.collect()))
    monkeypatch.setattr(facts, "HISTORY_BYTES", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = build(span, src)
        plan = plan_of(result)
        assert sorted(map(repr, result.collect())) == expected and expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and f"{column}#" in line)
    above = [re.sub(r"^[ :+-]*(\*\(\d+\) )?", "", line).split(" ")[0] for line in lines[:scan]]
    assert next(a for a in reversed(above) if a not in ("Filter", "Project", "ColumnarToRow")) == "BroadcastHashJoin"


def test_sorting_out_loses_no_matching_row(spark, monkeypatch):
    monkeypatch.setattr(facts, "HISTORY_BYTES", 1)
    history = spark.range(-5000, 5000).selectExpr("id AS k", "CAST(id AS STRING) AS s", "CAST(id AS INT) AS i", "id AS v")
    history = history.unionByName(history.limit(1).selectExpr("CAST(NULL AS BIGINT) AS k", "CAST(NULL AS STRING) AS s", "i", "v"))
    window = spark.range(0, 4000, 40).selectExpr("id AS w", "CAST(id AS STRING) AS t")
    for key, other in (("k", "w"), ("s", "t")):
        kept = of_window(history, key, window, other)
        assert kept.columns == history.columns
        found = {r[0] for r in kept.select(key).collect()}
        assert {r[0] for r in window.select(other).collect()} <= found and len(found) < 200
    # Keys of two types meet in a join only after a conversion: all rows stay.
    assert of_window(history, "i", window, "w").count() == history.count()
    assert of_window(history, "k", window.limit(0), "w").count() == 0


@pytest.mark.parametrize(
    "days",
    [
        [date(2004 + i // 12, 1 + i % 12, 28) for i in range(240)],
        [date(1960, 3, 1), date(2024, 1, 12)],
    ],
)
def test_scattered_report_dates_read_their_own_partitions_only(spark, tmp_path, days):
    rows = spark.range(1960 * 12, 2025 * 12).selectExpr(
        "CAST(1 AS DOUBLE) AS total_renovacion", "make_date(CAST(id DIV 12 AS INT), CAST(id % 12 AS INT) + 1, 28) AS fecha_operacion"
    )
    own = spark.createDataFrame([(2.0, d) for d in days], rows.schema)
    rows.unionByName(own).coalesce(1).write.partitionBy("fecha_operacion").parquet(str(tmp_path / "renewals"))
    span = listed_span(spark, days)
    assert span.is_held
    source = from_paths(spark, str(tmp_path))["renewals"]
    read = source.where(span.reads("fecha_operacion", ["report"]))
    assert {r[0] for r in read.select("fecha_operacion").distinct().collect()} == set(days)
    assert re.search(r"PartitionFilters: \[\S", plan_of(read)) and "PartitionFilters: []" not in plan_of(read)
    totals = securities.cdt_renewals(span, from_paths(spark, str(tmp_path)))
    assert totals.count() == len(days) and totals.where("renewals >= 2").count() == len(days)


def test_report_has_few_exchanges_without_broadcasts_by_size(spark):
    """Small lists are held, transactions and accounts feed one pass, whatever the statistics say."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        span = window_span(spark, date(2024, 1, 12))
        plan = plan_of(daily.cash_summary(daily.statements(daily.daily_metrics(span, sample_sources(spark, SF_DIR)))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") <= 25
    # Their columns in the sample tables: the time of a transaction, the last change of an account.
    for column in ("ts", "o_orderdate"):
        assert len(re.findall(rf"FileScan parquet \[[^\]]*\b{column}#\d+", plan)) <= {"ts": 4, "o_orderdate": 1}[column]


RAW_KEYS = r"Exchange hashpartitioning\((clave_canal|concepto)#"


@pytest.mark.parametrize("held_rows", [100_000, 0])
@pytest.mark.parametrize("build", [channels.ach_time_slots, channels.scan_totals, movements.unity_totals, movements.concept_derivation])
def test_raw_rows_are_not_shuffled_by_a_small_list(spark, monkeypatch, build, held_rows):
    """A list is broadcast when a look at it shows its size; rows are counted or summed before a longer one meets them."""
    src, span = sample_sources(spark, SF_DIR), window_span(spark, date(2024, 1, 12))
    expected = sorted(map(repr, build(span, src).collect()))
    monkeypatch.setattr(facts, "HELD_ROWS", held_rows)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = build(span, src)
        lines = plan_of(result).splitlines()
        assert sorted(map(repr, result.collect())) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for i, line in enumerate(lines):
        if re.search(RAW_KEYS, line):
            assert "HashAggregate" in next(x for x in lines[i + 1 :] if re.search("HashAggregate|FileScan", x))
    assert held_rows == 0 or not re.search(RAW_KEYS, "\n".join(lines))


def test_lists_are_held_by_rows_and_bytes(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "a"), (None, None)], "k long, v string")
    local = facts.held(rows)
    assert sorted(map(tuple, local.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str) and local.schema == rows.schema
    assert facts.held(rows.limit(0)).collect() == []
    monkeypatch.setattr(facts, "HELD_ROWS", 1)
    assert facts.held(rows) is None
    monkeypatch.setattr(facts, "HELD_ROWS", 10)
    monkeypatch.setattr(facts, "HELD_BYTES", 1)
    assert facts.held(rows) is None


def test_dates_beyond_the_held_bridge_prune_partitions_at_run_time(spark, monkeypatch, tmp_path):
    """The lazy bridge's distinct dates reach the partitions of the scan."""
    from florin.operators import report_dates

    rows = spark.range(0, 400).selectExpr("CAST(1 AS DOUBLE) AS total_renovacion", "date_add(DATE '2023-06-01', CAST(id AS INT)) AS fecha_operacion")
    rows.coalesce(1).write.partitionBy("fecha_operacion").parquet(str(tmp_path / "renewals"))
    days = [date(2023, 7, 3), date(2024, 1, 10), date(2024, 5, 20)]
    monkeypatch.setattr(report_dates, "MAX_HELD_ROWS", 10)
    span, src = listed_span(spark, days), from_paths(spark, str(tmp_path))
    assert not span.is_held
    result = securities.cdt_renewals(span, src)
    assert "dynamicpruning" in plan_of(result)
    assert sorted((r.report_date, float(r.renewals)) for r in result.collect()) == [(d, 1.0) for d in days]
    scan = report_dates.read_dates(src["renewals"], "fecha_operacion", span, ["report"])
    assert scan.count() == 3
    read = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if name.startswith(("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage")):
            return walk(node.plan())
        if name.startswith("Scan parquet"):
            read.append(node.metrics().apply("numPartitions").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    scan.collect()
    walk(scan._jdf.queryExecution().executedPlan())
    assert read == [3]
