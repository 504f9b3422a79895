"""Reciprocal transfers: A sends a token to B and B sends about as much of it back.

The plain self join emits every pair of a hot address pair. Pairs are only needed as counts,
and the count of partners of a transfer is the number of opposite amounts whose band covers
its amount. Every opposite amount opens its band at ``low x amount`` and closes it after
``high x amount``; a running total of opens minus closes, read at the transfer's own amount,
is that count. Work grows with rows, not with pairs, and equal amounts collapse first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferlens.operators.running import running_totals

_OPEN, _READ, _CLOSE = 0, 1, 2
_SLOTS_PER_OCTAVE = 1024


def _partner_counts(amounts: DataFrame, extra: Sequence[str], low: float, high: float) -> DataFrame:
    """Per (token, sender, receiver, *extra, amount): partners among the opposite transfers."""
    amount, n = F.col("amount"), F.col("n")

    def mark(at, kind: int, sender: str, receiver: str, delta, own) -> Column:
        return F.struct(
            F.col(sender).alias("sender"),
            F.col(receiver).alias("receiver"),
            at.alias("at"),
            F.lit(kind).alias("kind"),
            delta.cast("long").alias("delta"),
            own.alias("amount"),
            n.alias("n"),
        )

    none = F.lit(None).cast("double")
    marks = F.array(
        mark(amount, _READ, "sender", "receiver", F.lit(0), amount),
        mark(amount * F.lit(low), _OPEN, "receiver", "sender", n, none),
        mark(amount * F.lit(high), _CLOSE, "receiver", "sender", -n, none),
    )
    # an amount that is not positive has no band, and no band covers it
    sweep = amounts.where(amount > 0).select("token", *extra, F.explode(marks).alias("m")).select(
        "token", *extra, "m.*"
    )
    slot = F.floor(F.log2("at") * _SLOTS_PER_OCTAVE)
    done = running_totals(
        sweep,
        keys=["token", "sender", "receiver", *extra],
        order_by=["at", "kind"],
        slot=slot,
        sums={"partners": F.col("delta")},
    )
    return done.where((F.col("kind") == _READ) & (F.col("partners") > 0)).drop("at", "kind", "delta")


def _two_way(rows: DataFrame, extra: Sequence[str] = (), keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Rows whose address pair moves the token both ways (``extra`` narrows the pair).

    Most pairs never do, so this keeps the three-rows-per-amount sweep small. The kept pairs are
    unique: the hot side of the semi join is the row side, which adaptive skew handling splits.
    ``keep`` stores the pairs: once their size is known, few of them are broadcast and no row is shuffled.
    """
    low, high = F.least("sender", "receiver"), F.greatest("sender", "receiver")
    rows = rows.withColumns({"lo": low, "hi": high})
    keys = ["token", "lo", "hi", *extra]
    both = rows.groupBy(*keys).agg(
        F.bool_or(F.col("sender") == F.col("lo")).alias("up"), F.bool_or(F.col("sender") == F.col("hi")).alias("down")
    )
    pairs = both.where(F.col("up") & F.col("down")).select(*keys)
    if keep is not None:
        pairs = keep(pairs, "two-way-pairs")
    return rows.join(pairs, keys, "left_semi").drop("lo", "hi")


def reciprocal_transfers(
    transfers: DataFrame,
    token: str = "token_address",
    sender: str = "from_address",
    receiver: str = "to_address",
    amount: str = "amount",
    tx: str = "transaction_hash",
    low: float = 0.8,
    high: float = 1.2,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Two frames: partner pairs per token, and transfers that have a partner.

    A partner moves the same token the opposite way in another transaction, with
    ``low x its amount <= amount <= high x its amount``. The first frame is
    ``(token, pairs)``; the second ``(tx, token, sender, receiver, amount, partners)`` with one
    row per distinct transfer of a transaction. Both read the rows of two-way pairs several
    times; ``keep`` (see ``session.stored``) stores those few once.
    """
    rows = transfers.select(
        F.col(token).alias("token"),
        F.col(sender).alias("sender"),
        F.col(receiver).alias("receiver"),
        F.col(tx).alias("tx"),
        F.col(amount).cast("double").alias("amount"),
    ).where(F.col("sender").isNotNull() & F.col("receiver").isNotNull())
    rows = _two_way(rows, keep=keep)
    if keep is not None:
        rows = keep(rows, "two-way-transfers")

    per_tx = rows.groupBy("token", "sender", "receiver", "tx", "amount").agg(F.count(F.lit(1)).alias("n"))
    per_amount = rows.groupBy("token", "sender", "receiver", "amount").agg(F.count(F.lit(1)).alias("n"))
    anywhere = _partner_counts(per_amount, [], low, high)
    same_tx = _partner_counts(_two_way(per_tx, ["tx"]), ["tx"], low, high)

    pairs = (
        anywhere.select("token", (F.col("n") * F.col("partners")).alias("p"))
        .unionByName(same_tx.select("token", (-F.col("n") * F.col("partners")).alias("p")))
        .groupBy("token")
        .agg(F.sum("p").alias("pairs"))
        .where(F.col("pairs") > 0)
    )

    keys = ["token", "sender", "receiver", "amount"]
    matched = (
        per_tx.drop("n")
        .join(anywhere.select(*keys, "partners"), keys, "inner")
        .join(same_tx.select(*keys, "tx", F.col("partners").alias("own")), [*keys, "tx"], "left")
        .withColumn("partners", F.col("partners") - F.coalesce("own", F.lit(0)))
        .where(F.col("partners") > 0)
        .select("tx", *keys, "partners")
    )
    return pairs, matched
