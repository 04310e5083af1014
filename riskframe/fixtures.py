"""Lending views over the star-schema test tables (definitions in FIXTURES.md, part B)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.schemas import EPOCH_1998

LOAN_COLUMNS = [
    "o_orderkey", "loan_id", "loan_amnt", "term", "int_rate", "installment", "grade", "sub_grade",
    "emp_length", "home_ownership", "annual_inc", "verification_status", "purpose", "dti", "revol_util",
    "revol_bal", "tot_hi_cred_lim", "total_debt", "open_acc", "delinq_2yrs", "issue_d",
    "earliest_cr_line", "initial_list_status", "loan_status", "mths_since_last_delinq",
]

HOME_BY_SEGMENT = {
    "AUTOMOBILE": "RENT",
    "BUILDING": "MORTGAGE",
    "FURNITURE": "OWN",
    "HOUSEHOLD": "OTHER",
    "MACHINERY": "ANY",
}
PURPOSE_BY_PRIORITY = {
    "1": "debt_consolidation",
    "2": "credit_card",
    "3": "home_improvement",
    "5": "small_business",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lookup(key: Column, values: dict[str, str]) -> Column:
    expr = F.when(F.lit(False), F.lit(None).cast("string"))
    for k, v in values.items():
        expr = expr.when(key == k, F.lit(v))
    return expr


def home_ownership() -> Column:
    return _lookup(F.col("c_mktsegment"), HOME_BY_SEGMENT)


def purpose() -> Column:
    return _lookup(F.substring("o_orderpriority", 1, 1), PURPOSE_BY_PRIORITY)


def loan_status(k: Column) -> Column:
    status = F.col("o_orderstatus")
    return (
        F.when(status == "F", "Fully Paid")
        .when(
            status == "O",
            F.when(k % 3 == 0, "Current").when(k % 3 == 1, "In Grace Period").otherwise("Late (31-120 days)"),
        )
        .otherwise(
            F.when(k % 4 == 0, "Charged Off")
            .when(k % 4 == 1, "Default")
            .when(k % 4 == 2, "Issued")
            .otherwise("Somewhere Else")
        )
    )


def loans(spark: SparkSession, sf_dir: str, columns: list[str] | None = None, repeats: bool = True) -> DataFrame:
    """B1: one row per order, plus (``repeats``) an exact copy of every fiftieth.

    Only the tables that the asked ``columns`` need are read and joined.
    """
    columns = columns or LOAN_COLUMNS
    need = set(columns)
    orders = table(spark, sf_dir, "orders")
    base = orders
    if need & {"home_ownership", "annual_inc"}:
        base = base.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    if need & {"total_debt", "open_acc", "delinq_2yrs"}:
        lines = (
            table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey")
            .agg(F.count("*").alias("n_lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("qty"))
        )
        base = base.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    if "earliest_cr_line" in need:
        first = orders.groupBy(F.col("o_custkey").alias("first_custkey")).agg(
            F.min("o_orderdate").alias("earliest_cr_line")
        )
        base = base.join(first, F.col("o_custkey") == F.col("first_custkey"))

    k, c = F.col("o_orderkey"), F.col("o_custkey")
    letter = F.substring(F.lit("ABCDEFG"), (1 + k % 7).cast("int"), F.lit(1))
    n_lines = F.coalesce(F.col("n_lines"), F.lit(0).cast("bigint")) if "n_lines" in base.columns else F.lit(0)
    qty = F.coalesce(F.col("qty"), F.lit(0).cast("bigint")) if "qty" in base.columns else F.lit(0)
    years = c % 13
    definitions = {
        "o_orderkey": k,
        "loan_id": k.cast("string"),
        "loan_amnt": F.when(k % 41 != 0, F.col("o_totalprice") / 10),
        "term": F.when(k % 3 == 0, "60 months").otherwise("36 months"),
        "int_rate": F.when(
            k % 53 != 0, F.concat((5 + k % 27).cast("string"), F.lit("."), ((k * 7) % 10).cast("string"), F.lit("%"))
        ),
        "installment": F.col("o_totalprice") / 360,
        "grade": F.when(k % 97 == 0, "Z").otherwise(letter),
        "sub_grade": F.concat(letter, (1 + k % 5).cast("string")),
        "emp_length": F.when(years == 0, "< 1 year")
        .when(years == 1, "1 year")
        .when(years <= 9, F.concat(years.cast("string"), F.lit(" years")))
        .when(years == 10, "10+ years")
        .when(years == 11, "n/a"),
        "home_ownership": home_ownership(),
        "annual_inc": F.col("c_acctbal") * 12,
        "verification_status": F.when(k % 3 == 0, "Verified")
        .when(k % 3 == 1, "Source Verified")
        .otherwise("Not Verified"),
        "purpose": purpose(),
        "dti": ((k * 13) % 1200).cast("double") / 10,
        "revol_util": F.when(k % 29 != 0, ((k * 17) % 1010).cast("double") / 10),
        "revol_bal": (c * 37) % 50000,
        "tot_hi_cred_lim": 20000 + (c * 53) % 60000,
        "total_debt": (qty * 100).cast("double"),
        "open_acc": n_lines,
        "delinq_2yrs": F.when(n_lines >= 7, 1).otherwise(0),
        "issue_d": F.date_format("o_orderdate", "MMM-yyyy"),
        "earliest_cr_line": F.col("earliest_cr_line") if "earliest_cr_line" in need else None,
        "initial_list_status": F.when(k % 2 == 0, "f").otherwise("w"),
        "loan_status": loan_status(k),
        "mths_since_last_delinq": F.when(k % 10 >= 7, (k % 60).cast("double")),
    }
    out = base.select(*[definitions[name].alias(name) for name in columns], k.alias("_k"))
    if repeats:
        # the copies come from the same scan: no second read of the joined tables
        out = out.withColumn(
            "_copy", F.explode(F.when(F.col("_k") % 50 == 0, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
        ).drop("_copy")
    return out.drop("_k")


def target_flag(k: Column) -> Column:
    status = F.col("o_orderstatus")
    bad = ((status == "O") & (k % 3 == 2)) | ((status == "P") & (k % 4).isin(0, 1))
    return F.when(bad, 1).otherwise(0)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: labelled predictions, one row per order."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return rows.select(
        k.cast("string").alias("loan_id"),
        target_flag(k).alias("y"),
        (((k * 7919) % 1009 + 400 * target_flag(k)).cast("double") / 1409).alias("p"),
        home_ownership().alias("home_ownership"),
        purpose().alias("purpose"),
        F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open").alias("family"),
    ).withColumn("y_pred", F.when(F.col("p") > 0.5, 1).otherwise(0))


def scored_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 without the attributes: no customer table is read."""
    k = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .select(
            k.cast("string").alias("loan_id"),
            F.col("o_orderdate").cast("timestamp").alias("ts"),
            target_flag(k).alias("y"),
            (((k * 7919) % 1009 + 400 * target_flag(k)).cast("double") / 1409).alias("p"),
        )
        .withColumn("y_pred", F.when(F.col("p") > 0.5, 1).otherwise(0))
    )


def label_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3: real labels of the documents with a length rule as the prediction."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id").select(
        "doc_id",
        F.col("quality").cast("int").alias("y"),
        F.when(F.col("n_chars") >= 200, 1).otherwise(0).alias("y_pred"),
        "lang",
        "source",
    )


DRIFT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus"]


def drift_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """B4: line items before and from 1998 on; price and return flag shift on the current side."""
    lines = table(spark, sf_dir, "lineitem")
    cut = F.lit(EPOCH_1998).cast("timestamp_ntz")
    reference = lines.filter(F.col("l_shipdate") < cut).select(*DRIFT_COLUMNS)
    current = (
        lines.filter(F.col("l_shipdate") >= cut)
        .withColumns(
            {
                "l_extendedprice": F.col("l_extendedprice") * 1.125,
                "l_returnflag": F.when(
                    (F.col("l_returnflag") == "N") & (F.col("l_orderkey") % 5 == 0), "X"
                ).otherwise(F.col("l_returnflag")),
            }
        )
        .select(*DRIFT_COLUMNS)
    )
    return reference, current


def request_log(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """B5: one served request per event."""
    if streaming:
        schema = table(spark, sf_dir, "events").schema
        events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    else:
        events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        (F.col("value") / 1000).alias("latency_s"),
    )


DRIFT_LOG_START = "2024-01-08 00:00:00"


def drift_log(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """B9: events as a prediction log; amounts grow in every fourth hour, scores halve in every sixth, a new kind comes at ten."""
    if streaming:
        events = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events*.parquet")
    else:
        events = table(spark, sf_dir, "events")
    at = F.col("ts").cast("timestamp")
    late = at >= F.lit(DRIFT_LOG_START).cast("timestamp")
    score = ((F.col("event_id") * 7919) % 1009).cast("double") / 1009
    return events.select(
        at.alias("ts"),
        F.when(late & (F.hour("ts") % 4 == 0), F.col("value") * 1.5).otherwise(F.col("value")).alias("amount"),
        F.when(late & (F.hour("ts") == 10) & (F.col("event_type") == "view"), "preview").otherwise(F.col("event_type")).alias("kind"),
        (F.col("user_id") % 3 == 0).alias("flagged"),
        F.when(late & (F.hour("ts") % 6 == 0), score * 0.5).otherwise(score).alias("score"),
    )


def lookup_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """B6: purchases ask for features, views are the feature snapshots."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    requests = events.filter(F.col("event_type") == "purchase").select(
        "event_id", F.col("user_id").alias("loan_id"), F.col("ts").alias("req_ts"), "value"
    )
    snapshots = events.filter(F.col("event_type") == "view").select(
        F.col("user_id").alias("loan_id"), F.col("ts").alias("feature_ts"), F.col("event_id").alias("version"), "value"
    )
    return requests, snapshots


# B7 fields that the loan view lacks, as fixed arithmetic on the order key.
REQUEST_EXTRAS = {
    "inq_last_6mths": lambda k: (k % 4).cast("int"),
    "pub_rec": lambda k: (k % 2).cast("int"),
    "total_acc": lambda k: (5 + k % 30).cast("int"),
    "total_pymnt": lambda k: (k % 1000).cast("double"),
    "total_pymnt_inv": lambda k: (k % 1000).cast("double"),
    "total_rec_prncp": lambda k: (k % 800).cast("double"),
    "total_rec_int": lambda k: (k % 200).cast("double"),
    "total_rec_late_fee": lambda k: F.lit(0.0),
    "recoveries": lambda k: F.lit(0.0),
    "collection_recovery_fee": lambda k: F.lit(0.0),
    "last_pymnt_amnt": lambda k: (k % 300).cast("double"),
}


def request_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed scoring requests, one per order; many break a rule (grade Z, negative income, …)."""
    from riskframe.schemas import REQUEST_RULES

    k = F.col("o_orderkey")
    rows = loans(spark, sf_dir, [c for c in LOAN_COLUMNS if c != "earliest_cr_line"], repeats=False)
    rows = rows.withColumns(
        {
            "int_rate": F.when(k % 53 != 0, (5 + k % 27).cast("double") + ((k * 7) % 10) / F.lit(10.0)),
            "grade": F.when(k % 11 == 0, "Z").otherwise(F.col("grade")),
            "emp_length": F.when(k % 13 != 0, (k % 13).cast("double")),
            "open_acc": F.col("open_acc").cast("int"),
            "revol_bal": F.col("revol_bal").cast("int"),
            **{name: make(k) for name, make in REQUEST_EXTRAS.items()},
        }
    )
    return rows.select(k, *[r.field for r in REQUEST_RULES])


def message_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed rows behind B7, ``(o_orderkey, ts, fields…)``, one per message; a text is several times as long."""
    k = F.col("o_orderkey")
    dates = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("ts"))
    rows = request_rows(spark, sf_dir).join(dates, "o_orderkey")
    return rows.withColumn(
        "_copy", F.explode(F.when(k % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    ).drop("_copy")


def message_texts(rows: DataFrame) -> DataFrame:
    """Typed rows as ``(o_orderkey, ts, value)``."""
    k = F.col("o_orderkey")
    flat = F.to_json(F.struct(*[c for c in rows.columns if c not in ("o_orderkey", "ts")]))
    text = F.when(k % 5 == 0, F.concat(F.lit('{"input": '), F.col("flat"), F.lit("}"))).otherwise(F.col("flat"))
    rows = rows.select(k, "ts", flat.alias("flat"))
    return rows.select(k, "ts", F.when(k % 37 == 0, F.substring("flat", 1, 40)).otherwise(text).alias("value"))


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B7: JSON texts ``(o_orderkey, ts, value)``: flat or wrapped, some cut short, some repeated."""
    return message_texts(message_rows(spark, sf_dir))


RUN_METRICS = ["accuracy", "precision", "recall", "f1_score", "auc", "auc_gap", "max_positive_rate_difference"]


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8: one training run per order month, its metrics taken from the scored rows of that month.

    Runs of every fifth month logged no area, runs of every seventh no precision.
    """
    from riskframe.operators.metrics import confusion, long_form, rates, ratio, roc_auc

    rows = scored(spark, sf_dir).join(
        table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").cast("string").alias("loan_id"), F.date_format("o_orderdate", "yyyy-MM").alias("month")
        ),
        "loan_id",
    )
    by_group = confusion(rows, keys=["month", "home_ownership"]).withColumn(
        "rate", ratio(F.col("tp") + F.col("fp"), F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn"))
    )
    spread = by_group.groupBy("month").agg((F.max("rate") - F.min("rate")).alias("max_positive_rate_difference"))
    wide = (
        confusion(rows, keys=["month"])
        .withColumns(rates())
        .join(roc_auc(rows, keys=["month"]), "month")
        .join(spread, "month")
        .withColumn("auc_gap", F.abs(F.col("auc") - 0.8))
    )
    month_no = F.substring("month", 6, 2).cast("int")
    lost = ((F.col("name") == "auc") & (month_no % 5 == 0)) | ((F.col("name") == "precision") & (month_no % 7 == 0))
    return (
        long_form(wide, ["month"], RUN_METRICS)
        .filter(~lost)
        .select(
            F.concat(F.lit("run-"), "month").alias("run_id"),
            F.concat(F.lit("model-"), F.substring("month", 1, 4)).alias("model"),
            "name",
            "value",
            F.to_timestamp("month", "yyyy-MM").alias("ts"),
        )
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8: model versions, one per order; the customer is the model name."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("model-"), F.col("o_custkey").cast("string")).alias("name"),
        k.alias("version"),
        F.when(F.col("o_orderstatus") == "F", "Archived")
        .when(F.col("o_orderstatus") == "O", "Staging")
        .otherwise("Production")
        .alias("stage"),
        F.when(k % 10 == 0, "champion").when(k % 10 == 1, "challenger").alias("alias"),
        F.col("o_orderdate").cast("timestamp").alias("creation_ts"),
        F.concat(F.lit("run-"), k.cast("string")).alias("run_id"),
    )


def promotion_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8: the same orders read as promotions of four versions per customer model."""
    k = F.col("o_orderkey")
    return registry(spark, sf_dir).select(
        "name",
        (k_mod := F.col("version") % 4).alias("version"),
        F.when(F.col("version") % 3 != 0, F.col("stage")).alias("stage"),
        "alias",
        F.when(k_mod == 1, F.concat(F.lit("promoted by "), "run_id")).alias("description"),
        F.col("creation_ts").alias("ts"),
        F.col("version").alias("seq"),
    )
