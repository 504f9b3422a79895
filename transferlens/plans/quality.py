"""Quality gates and reports. A gate returns one row per rule:
(table, rule, value, threshold, severity, passed)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferlens.functions import money
from transferlens.operators.reciprocal import reciprocal_transfers
from transferlens.operators.stats import rate, sum_where, top, variation
from transferlens.schemas import REQUEST_LOG
from transferlens.sources.files import CORRUPT
from transferlens.streaming.messages import once


@dataclass(frozen=True)
class Rule:
    """``measure`` names a column of the one-row measures frame."""

    measure: str
    at_least: float | None = None
    at_most: float | None = None
    severity: str = "critical"

    def row(self) -> Column:
        value = F.col(self.measure).cast("double")
        limit = self.at_least if self.at_least is not None else self.at_most
        good = value >= F.lit(limit) if self.at_least is not None else value <= F.lit(limit)
        return F.struct(
            F.lit(self.measure).alias("rule"),
            F.round(value, 6).alias("value"),
            F.lit(float(limit)).alias("threshold"),
            F.lit(self.severity).alias("severity"),
            # a measure over nothing (no rows) is not a violation of its own; row-count rules catch it
            F.coalesce(good, F.lit(True)).alias("passed"),
        )


def apply_rules(measures: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    rows = measures.select(F.explode(F.array(*[r.row() for r in rules])).alias("r"))
    return rows.select(F.lit(table).alias("table"), "r.*")


def _side_by_side(parts: Sequence[DataFrame]) -> DataFrame:
    """One-row frames as one row of all their columns, by an aggregate over their union."""
    names = [c for p in parts for c in p.columns]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return merged.agg(*[F.max(n).alias(n) for n in names])


def _rows(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def retention(kept: DataFrame, source: DataFrame, name: str = "retention") -> DataFrame:
    """Rows kept per source row; 0 for an empty source."""
    both = _side_by_side([_rows(kept, "kept_rows"), _rows(source, "source_rows")])
    share = F.col("kept_rows") / F.when(F.col("source_rows") > 0, F.col("source_rows"))
    return both.withColumn(name, F.coalesce(share, F.lit(0.0)))


# ---- enriched transactions -------------------------------------------------------------------

ENRICHED_RULES = (
    Rule("retention", at_least=0.99),
    Rule("success_rate", at_least=0.8),
    Rule("tx_count", at_least=1000),
    Rule("avg_fee_eth", at_most=1.0),
)


def enriched_report(enriched: DataFrame) -> DataFrame:
    """Key figures of the day's transactions, from one evaluation of ``enriched``.

    Every transaction becomes one row per side, so that its addresses are counted beside its figures, which only
    the sender's row carries. A missing address counts as one more.
    """
    sides = F.array(
        F.struct(F.lit(True).alias("once"), F.col("from_address").alias("address")),
        F.struct(F.lit(False).alias("once"), F.col("to_address").alias("address")),
    )
    rows = enriched.select("is_success", "tx_fee_eth", "value_eth", "is_contract_call", "is_contract_deploy", "tx_type", F.inline(sides))

    def only(value: Column) -> Column:
        return F.when(F.col("once"), value)

    figures = rows.agg(
        F.count_if("once").alias("tx_count"),
        rate(only(F.col("is_success"))).alias("success_rate"),
        rate(only(F.col("is_success").isNotNull())).alias("receipt_coverage"),
        F.avg(only(F.col("tx_fee_eth").cast("double"))).alias("avg_fee_eth"),
        F.sum(only(F.col("value_eth").cast("double"))).alias("total_eth"),
        F.count_if(only(F.col("is_contract_call"))).alias("call_count"),
        F.count_if(only(F.col("is_contract_deploy"))).alias("deploy_count"),
        F.count_if(only(F.col("tx_type") == "eip1559")).alias("eip1559_count"),
        F.count_distinct("address").alias("named"),
        F.coalesce(F.max(F.col("address").isNull().cast("long")), F.lit(0)).alias("nameless"),
    )
    count = F.when(F.col("tx_count") > 0, F.col("tx_count"))
    figures = figures.withColumns(
        {
            "call_pct": F.round(F.col("call_count") / count * 100, 2),
            "eip1559_pct": F.coalesce(F.round(F.col("eip1559_count") / count * 100, 2), F.lit(0.0)),
            "active_addresses": F.col("named") + F.col("nameless"),
        }
    )
    return figures.drop("named", "nameless")


#: What the sources of a table hold: a frame to count, or the counts if they were taken before.
Source = DataFrame | Mapping[str, int]


def _with_counts(measures: DataFrame, source: Source, count: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One row of measures with the counts of its source."""
    if isinstance(source, DataFrame):
        return _side_by_side([measures, count(source)])
    return measures.withColumns({name: F.lit(n).cast("long") for name, n in source.items()})


def seen(observation: Observation) -> dict:
    """The observed counts; none where the optimizer found the plan empty and dropped the count with it."""
    try:
        return observation.get
    except Py4JJavaError:
        return {}


def settled(seen: dict, written: dict, recount: Callable[[], dict]) -> dict:
    """Source counts that were observed while a table was written from them.

    Tasks take these counts as they run, and a task that is repeated after a lost executor counts its rows once more. So counts
    that do not agree with what was written are taken anew, from the source; a real loss of rows is seen all the same.
    """
    return seen if all(seen.get(name) == count for name, count in written.items()) else recount()


def check_enriched(enriched: DataFrame, source: Source, rules: Sequence[Rule] = ENRICHED_RULES) -> DataFrame:
    """The rows kept are the report's own count, so ``enriched`` is evaluated once. ``source`` is the transactions or their ``source_rows``."""
    measures = _with_counts(enriched_report(enriched), source, lambda df: _rows(df, "source_rows"))
    share = F.col("tx_count") / F.when(F.col("source_rows") > 0, F.col("source_rows"))
    return apply_rules(measures.withColumn("retention", F.coalesce(share, F.lit(0.0))), "txn_enriched", rules)


# ---- token flow ------------------------------------------------------------------------------

FLOW_RULES = (
    Rule("retention", at_least=0.99),
    Rule("row_count", at_least=10),
    Rule("active_tokens", at_least=1),
    Rule("wash_ratio", at_most=0.5, severity="warning"),
    # never fails: tells how much of all transfers is of tracked tokens
    Rule("unfiltered_retention", at_least=0.0, severity="info"),
)


#: What the gate reads of a flow: a copy that is made for it alone needs no other columns.
FLOW_READ = ("transaction_hash", "token_address", "from_address", "from_category", "to_address", "to_category", "amount")


def flow_report(flow: DataFrame) -> DataFrame:
    dex = (F.col("from_category") == "DEX") | (F.col("to_category") == "DEX")
    return flow.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("token_address").alias("active_tokens"),
        F.coalesce(rate(F.coalesce(dex, F.lit(False))), F.lit(0.0)).alias("dex_ratio"),
        variation("amount").alias("transfer_cv"),
    )


def private_flow(flow: DataFrame) -> DataFrame:
    """Flow in which neither side is an exchange contract."""
    return flow.where((F.col("from_category") != "DEX") & (F.col("to_category") != "DEX"))


Keep = Callable[[DataFrame, str], DataFrame] | None


def wash_summary(flow: DataFrame, keep: Keep = None) -> DataFrame:
    """One row: transactions with a reciprocal partner among non-DEX transfers, and all pairs."""
    pairs, matched = reciprocal_transfers(private_flow(flow), keep=keep)
    return _side_by_side(
        [
            matched.select("tx").distinct().agg(F.count(F.lit(1)).alias("wash_transactions")),
            pairs.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("wash_pairs")),
        ]
    )


def wash_by_symbol(flow: DataFrame, n: int = 5, keep: Keep = None) -> DataFrame:
    """Symbols with most reciprocal pairs. The symbol belongs to the token, so it joins to counts."""
    pairs, _ = reciprocal_transfers(private_flow(flow), keep=keep)
    symbols = flow.groupBy(F.col("token_address").alias("token")).agg(F.max("symbol").alias("symbol"))
    totals = pairs.join(symbols, "token").groupBy("symbol").agg(F.sum("pairs").alias("pairs"))
    return top(totals, [F.desc("pairs"), F.asc("symbol")], n)


def volume_by_symbol(flow: DataFrame, n: int = 5) -> DataFrame:
    named = flow.where(F.col("symbol") != "UNKNOWN")
    totals = named.groupBy("symbol").agg(F.round(F.sum("amount"), 4).alias("volume"))
    return top(totals, [F.desc("volume"), F.asc("symbol")], n)


def busiest_hours(flow: DataFrame, n: int = 3) -> DataFrame:
    counts = flow.groupBy("hour").agg(F.count(F.lit(1)).alias("tx_count"))
    return top(counts, [F.desc("tx_count"), F.asc("hour")], n)


def dex_share(flow: DataFrame, n: int = 3) -> DataFrame:
    """Transfers per DEX; the sender's label counts where both sides are one."""
    side = F.coalesce(
        F.when(F.col("from_category") == "DEX", F.col("from_label")),
        F.when(F.col("to_category") == "DEX", F.col("to_label")),
    )
    counts = flow.select(side.alias("dex")).where(F.col("dex").isNotNull()).groupBy("dex")
    return top(counts.agg(F.count(F.lit(1)).alias("tx_count")), [F.desc("tx_count"), F.asc("dex")], n)


def tracked_transfers(transfers: DataFrame, tokens: DataFrame) -> DataFrame:
    """The transfers with ``tracked``, true for those of known tokens and else null."""
    known = tokens.select("token_address").distinct().withColumn("tracked", F.lit(True))
    return transfers.join(known, "token_address", "left")


def flow_sources(transfers: DataFrame, tokens: DataFrame) -> DataFrame:
    """Transfers of tracked tokens, and all, from one pass."""
    return tracked_transfers(transfers, tokens).agg(F.count("tracked").alias("tracked_rows"), F.count(F.lit(1)).alias("all_rows"))


def source_counts(observed: Observation, written: int, transfers: DataFrame, tokens: DataFrame) -> dict:
    """The counts of ``flow_sources``, as ``enrich.token_flow`` observed them while ``written`` rows of flow were stored.

    They are taken anew from the transfers if they disagree with what was written, or if a token is listed more than once.
    """
    listed = tokens.groupBy("token_address").agg(F.count(F.lit(1)).alias("n"))
    counts = {} if listed.where(F.col("n") > 1).head(1) else seen(observed)
    return settled(counts, {"tracked_rows": written}, lambda: flow_sources(transfers, tokens).first().asDict())


def check_flow(
    flow: DataFrame,
    transfers: Source,
    tokens: DataFrame | None = None,
    rules: Sequence[Rule] = FLOW_RULES,
    keep: Keep = None,
) -> DataFrame:
    """Retention counts against the transfers of tracked tokens, the rows the flow should hold.

    Both source counts come from one pass over the transfers, or are given as ``tracked_rows`` and ``all_rows``; the rows kept
    come from the report.
    """
    measures = _side_by_side([flow_report(flow), wash_summary(flow, keep)])
    measures = _with_counts(measures, transfers, lambda df: flow_sources(df, tokens))

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.col(part) / F.when(F.col(whole) > 0, F.col(whole)), F.lit(0.0))

    ratios = {
        "retention": share("row_count", "tracked_rows"),
        "unfiltered_retention": share("row_count", "all_rows"),
        "wash_ratio": share("wash_transactions", "row_count"),
    }
    return apply_rules(measures.withColumns(ratios), "token_flow", rules)


# ---- whale transactions ----------------------------------------------------------------------

WHALE_RULES = (
    Rule("row_count", at_least=1),
    Rule("null_rows", at_most=0),
    Rule("non_positive_rows", at_most=0),
    Rule("flag_rate", at_most=0.9, severity="warning"),
)


def whale_report(whales: DataFrame) -> DataFrame:
    deposit, withdrawal = F.col("flow_type") == "CEX_DEPOSIT", F.col("flow_type") == "CEX_WITHDRAWAL"
    between = (F.col("from_category") == "CEX") & (F.col("to_category") == "CEX")
    essential = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in ("hash", "from_address", "to_address", "value_eth")])

    def total(condition: Column) -> Column:
        return F.coalesce(sum_where(condition, "value_eth"), F.lit(0)).cast("double")

    figures = whales.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(essential).alias("null_rows"),
        F.count_if(F.col("value_eth") <= 0).alias("non_positive_rows"),
        rate(F.col("flag_high_freq") | deposit | withdrawal | between).alias("flag_rate"),
        total(deposit).alias("cex_deposit_eth"),
        total(withdrawal).alias("cex_withdrawal_eth"),
        total(between).alias("cex_to_cex_eth"),
        F.count_distinct(F.when(F.col("flag_high_freq"), F.col("from_address"))).alias("high_freq_senders"),
    )
    return figures.withColumn("net_cex_flow_eth", F.col("cex_deposit_eth") - F.col("cex_withdrawal_eth"))


def deposits_by_exchange(whales: DataFrame, n: int = 3) -> DataFrame:
    into = whales.where(F.col("flow_type") == "CEX_DEPOSIT").groupBy("to_label")
    totals = into.agg(F.round(F.sum("value_eth"), 6).cast("double").alias("total_in"))
    return top(totals, [F.desc("total_in"), F.asc("to_label")], n)


def largest_transfers(whales: DataFrame, n: int = 3) -> DataFrame:
    rows = whales.select("hash", "from_address", F.col("value_eth").cast("double").alias("value_eth"), "from_label")
    return top(rows, [F.desc("value_eth"), F.asc("hash")], n)


def check_whales(whales: DataFrame, rules: Sequence[Rule] = WHALE_RULES) -> DataFrame:
    return apply_rules(whale_report(whales), "whale_txns", rules)


# ---- raw tables ------------------------------------------------------------------------------


def check_bronze(
    transactions: DataFrame, receipts: DataFrame, min_eth: float = 100, empty: DataFrame | None = None
) -> DataFrame:
    """As many receipts as large transactions, and no empty file."""
    parts = [
        transactions.where(money.at_least_eth("value", min_eth)).agg(F.count(F.lit(1)).alias("whale_hashes")),
        _rows(receipts, "receipts"),
    ]
    if empty is not None:
        parts.append(_rows(empty, "empty_files"))
    measures = _side_by_side(parts).withColumn("receipt_gap", F.abs(F.col("whale_hashes") - F.col("receipts")))
    if empty is None:
        measures = measures.withColumn("empty_files", F.lit(0))
    return apply_rules(measures, "bronze", (Rule("receipt_gap", at_most=0), Rule("empty_files", at_most=0)))


def block_mismatches(blocks: DataFrame, transactions: DataFrame, receipts: DataFrame) -> DataFrame:
    """Blocks whose stated count, transactions and receipts differ.

    The three tables are counted per block map side and met in one aggregate, not by joins.
    """

    def counted(df: DataFrame, block: str, which: str, amount: Column) -> DataFrame:
        rest = {c: F.lit(0).cast("long") for c in ("stated", "transactions", "receipts") if c != which}
        return df.select(F.col(block).alias("block_number"), amount.cast("long").alias(which)).withColumns(rest)

    met = (
        counted(blocks, "number", "stated", F.col("transaction_count"))
        .unionByName(counted(transactions, "block_number", "transactions", F.lit(1)))
        .unionByName(counted(receipts, "block_number", "receipts", F.lit(1)))
        .groupBy("block_number")
        .agg(*[F.sum(c).alias(c) for c in ("stated", "transactions", "receipts")])
    )
    return met.where((F.col("stated") != F.col("transactions")) | (F.col("transactions") != F.col("receipts")))


# ---- request log -----------------------------------------------------------------------------


def parse_request_log(lines: DataFrame) -> DataFrame:
    """JSON log lines (column ``value``) to typed rows; ``tags`` names what could not be read."""
    # every field is read as text, so only a line that is no JSON object counts as corrupt
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in REQUEST_LOG])
    body = F.from_json("value", as_text.add(CORRUPT, T.StringType()), {"columnNameOfCorruptRecord": CORRUPT})
    parsed = lines.select(once(body).alias("r"))
    text = F.col("r.timestamp")
    time = F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss,SSS")),
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T"), text).try_cast("timestamp"),
    )
    broken = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()
    tags = F.array_compact(
        F.array(
            F.when(broken, "_json_parse_failure"),
            F.when(text.isNotNull() & time.isNull(), "_date_parse_failure"),
        )
    )
    fields = [
        F.col(f"r.{f.name}").try_cast(f.dataType).alias(f.name) for f in REQUEST_LOG if f.name != "timestamp"
    ]
    return parsed.select(time.alias("event_time"), *fields, tags.alias("tags"))


def request_kpis(log: DataFrame, slow_ms: float = 500) -> DataFrame:
    """Requests, slow share, server-error share and latency per method and path."""
    requests = log.where(F.col("method").isNotNull()).groupBy("method", "url")
    return requests.agg(
        F.count(F.lit(1)).alias("requests"),
        F.round(F.count_if(F.col("duration_ms") >= slow_ms) / F.count(F.lit(1)), 6).alias("slow_share"),
        F.round(F.count_if(F.col("status_code").between(500, 599)) / F.count(F.lit(1)), 6).alias("error_share"),
        F.round(F.avg("duration_ms"), 4).alias("avg_ms"),
        F.percentile_approx("duration_ms", 0.95, 10_000).alias("p95_ms"),
    )


# ---- all checks ------------------------------------------------------------------------------


class QualityError(RuntimeError):
    """Raised once with every failed critical rule."""


def all_checks(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), checks)


def enforce(results: DataFrame) -> None:
    """Raises if a critical rule failed. The rows are one per rule, so collecting them is bounded."""
    failed = results.where(~F.col("passed") & (F.col("severity") == "critical")).collect()
    if failed:
        parts = [f"{r['table']}: {r['rule']} = {r['value']} (limit {r['threshold']})" for r in failed]
        raise QualityError(" | ".join(sorted(parts)))
