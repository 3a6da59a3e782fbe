"""Applying a feed of inserts, updates and deletes (problem 1), in SQL only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import units
from tidemark.session import cut, small

#: Copies of the per-book row that a hot book's changes are spread over when they are joined to it.
SALTS = 16
#: Update ids in a block of the chain check. Ids are distinct within a book, so this also bounds its rows.
SPAN = 1 << 17


def last_writer(changes: DataFrame, keys: Sequence[str], seq: str, op: str, fields: Sequence[str]) -> DataFrame:
    """The current row of each key after all changes, by column-wise last-writer-wins.

    ``op`` is ``update`` (sets the fields that are not null), ``insert`` or ``replace`` (the same,
    but what was set before no longer counts) or ``delete``; other values are ignored. ``seq``
    orders the changes of a key; rows may come repeatedly and in any order.

    One aggregation, combined on the map side: per field the last change that set it (``max_by``)
    and that change's sequence; per key the sequence of the last delete or replacement. A field
    counts if its last write is not older than the floor. Nothing is ordered, collected or joined,
    so a key with a third of the rows costs no more than others.

    Defined cases: null ``seq`` or ``op``: ignored. Null in a key: such rows form a key of their
    own, as in GROUP BY. A field that no counting change set: null. Two changes of one key with
    equal ``seq``: a delete wins over what is set at the same sequence; otherwise they must agree.
    A key whose last change deletes it, and an empty feed: no row. Other columns are dropped.
    """
    o = F.lower(F.col(op))
    sets = o.isin("insert", "update", "replace")
    src = changes.where(F.col(seq).isNotNull() & (sets | (o == "delete"))).select(
        *[F.col(k) for k in keys], F.col(seq).alias("__seq"), o.alias("__op"), *[F.col(f).alias(f"__f_{i}") for i, f in enumerate(fields)]
    )
    write = F.col("__op") != "delete"
    aggs: list[Column] = [
        F.max(F.when(~write, F.col("__seq"))).alias("__deleted"),
        F.max(F.when(F.col("__op").isin("insert", "replace"), F.col("__seq"))).alias("__replaced"),
        F.max(F.when(write, F.col("__seq"))).alias("__alive"),
    ]
    for i in range(len(fields)):
        at = F.when(write & F.col(f"__f_{i}").isNotNull(), F.col("__seq"))
        aggs += [F.max_by(f"__f_{i}", at).alias(f"__v_{i}"), F.max(at).alias(f"__s_{i}")]
    state = src.groupBy(*keys).agg(*aggs).where(F.col("__alive").isNotNull() & (F.col("__deleted").isNull() | (F.col("__alive") > F.col("__deleted"))))
    after = lambda s: (F.col("__deleted").isNull() | (s > F.col("__deleted"))) & (F.col("__replaced").isNull() | (s >= F.col("__replaced")))
    return state.select(*keys, *[F.when(after(F.col(f"__s_{i}")), F.col(f"__v_{i}")).alias(f) for i, f in enumerate(fields)])


def chains(spans: DataFrame, anchors: DataFrame, keys: Sequence[str], first: str, last: str, previous: str, anchor: str, span: int = SPAN, salts: int = SALTS) -> DataFrame:
    """How far the messages of each key form an unbroken chain from its anchor.

    ``spans`` has one row per message with the id range ``first``..``last`` and the ``last`` of the
    message before (``previous``); ``anchors`` one row per key with the id ``anchor``. Messages
    with ``last`` < anchor do not count. The first other must have ``first`` <= anchor; each
    further one's ``previous`` must be the ``last`` of the one before.

    Result: keys, ``anchor`` and ``until`` (the ``last`` of the first message that breaks the
    chain, null without a break) for each key with an anchor and a fitting first message.

    Blocks of ``span`` ids are checked on their own and stitched by their first and last rows, so
    no task has a whole key. Repeats of one ``last`` must agree; else the largest ids count. Nulls
    in any of the columns: the message is ignored.
    """
    k = list(keys)
    ok = F.lit(True)
    for c in (*k, first, last, previous):
        ok = ok & F.col(c).isNotNull()
    salt = F.pmod(F.xxhash64(F.col(last)), F.lit(salts)).cast("int").alias("__salt")
    a = anchors.select(*k, F.col(anchor).alias("__anchor")).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    m = (
        spans.where(ok)
        .select(*k, F.col(first).alias("__first"), F.col(last).alias("__last"), F.col(previous).alias("__prev"), salt)
        .groupBy(*k, "__salt", "__last")
        .agg(F.max("__first").alias("__first"), F.max("__prev").alias("__prev"))
        .join(a, [*k, "__salt"])
        .where(F.col("__last") >= F.col("__anchor"))
    )
    block = F.expr(f"__last div {span}")
    m = m.withColumn("__block", block).withColumn("__before", F.lag("__last").over(Window.partitionBy(*k, "__block").orderBy("__last")))
    b = m.groupBy(*k, "__block").agg(
        F.max("__anchor").alias("__anchor"),
        F.min("__last").alias("__lo"),
        F.max("__last").alias("__hi"),
        F.min_by("__first", "__last").alias("__first"),
        F.min_by("__prev", "__last").alias("__prev"),
        F.min(F.when(F.col("__before").isNotNull() & (F.col("__prev") != F.col("__before")), F.col("__last"))).alias("__inner"),
    )
    b = b.withColumn("__left", F.lag("__hi").over(Window.partitionBy(*k).orderBy("__block")))
    edge = F.when(F.col("__left").isNotNull() & (F.col("__prev") != F.col("__left")), F.col("__lo"))
    return (
        b.groupBy(*k)
        .agg(F.max("__anchor").alias(anchor), F.min_by("__first", "__block").alias("__first"), F.min(F.least(edge, F.col("__inner"))).alias("until"))
        .where(F.col("__first") <= F.col(anchor))
        .drop("__first")
    )


def final_books(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """The book of each symbol and connection as it finally stands, from depth and depth_snapshot rows.

    Base: the snapshot with the largest ``last_update_id`` (of equal ones the one received last).
    Then the messages that :func:`chains` accepts, in the order of ``final_update_id``; among
    repeats the one received first. Level by level this is :func:`last_writer` over the key (book,
    side, price): the snapshot and each change set the quantity, quantity zero deletes.

    Defined cases: null symbol or connection: no book. Null side: no levels. A level with a null
    or unreadable price or quantity: ignored. One price twice in a message: the later one counts.
    A null receive number counts as 0; rows of one message that agree in it must agree. Prices and
    quantities are whole multiples of 10^-8, decimal(31,0), so up to 10^22. Empty input: no rows.
    """
    book = ["exchange_symbol", "connection_id"]
    src = rows.where(F.col("stream_type").isin("depth", "depth_snapshot") & F.col("exchange_symbol").isNotNull() & F.col("connection_id").isNotNull())
    depth = src.where(F.col("stream_type") == "depth")
    anchors = src.where(F.col("stream_type") == "depth_snapshot").groupBy(*book).agg(F.max("last_update_id").alias("anchor")).where(F.col("anchor").isNotNull())
    reach = chains(depth, anchors, book, "first_update_id", "final_update_id", "previous_final_update_id", "anchor", salts=salts)
    reach = reach.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    is_snap = F.col("stream_type") == "depth_snapshot"
    at = F.when(is_snap, F.col("last_update_id")).otherwise(F.col("final_update_id"))
    change = src.select(*book, is_snap.alias("__snap"), at.alias("__at"), F.coalesce("receive_seq", F.lit(0)).alias("__r"), "bids", "asks", "first_update_id", "previous_final_update_id")
    change = change.where(F.col("__at").isNotNull() & (F.col("__snap") | (F.col("first_update_id").isNotNull() & F.col("previous_final_update_id").isNotNull())))
    # of messages that came several times, the one that counts; only ids and numbers are shuffled, and joined by broadcast if few
    which = F.when(F.col("__snap"), F.max("__r")).otherwise(F.min("__r"))
    again = change.groupBy(*book, "__snap", "__at").agg(which.alias("__counts"), F.min("__r").alias("__a"), F.max("__r").alias("__b"))
    again = small(cut(again.where("__a <> __b").drop("__a", "__b")))
    change = change.join(again, [*book, "__snap", "__at"], "left").where(F.col("__counts").isNull() | (F.col("__counts") == F.col("__r"))).drop("__counts", "__r")
    change = change.withColumn("__salt", F.pmod(F.xxhash64("__at"), F.lit(salts)).cast("int"))
    kept = change.join(reach, [*book, "__salt"]).where(
        F.when(F.col("__snap"), F.col("__at") == F.col("anchor")).otherwise((F.col("__at") >= F.col("anchor")) & (F.col("until").isNull() | (F.col("__at") < F.col("until"))))
    )
    side = lambda name, levels: F.transform(F.coalesce(F.col(levels), F.array().cast("array<struct<price:string,quantity:string>>")), lambda x, i: F.struct(F.lit(name).alias("side"), i.alias("pos"), x["price"].alias("p"), x["quantity"].alias("q")))
    levels = kept.select(*book, "__snap", "__at", F.explode(F.concat(side("bid", "bids"), side("ask", "asks"))).alias("l"))
    # one number orders the changes of a book: the id, a snapshot before the messages that share its id, the place in the message
    whole = lambda c, n: c.cast(f"decimal({n},0)")
    order = whole(F.col("__at"), 19) * whole(F.lit(2), 1) + whole(F.when(F.col("__snap"), 0).otherwise(1), 1)
    seq = whole(order, 21) * whole(F.lit(1 << 31), 10) + whole(F.col("l.pos"), 10)
    changes = levels.select(
        *book, F.col("l.side").alias("side"), units(F.col("l.p")).alias("price_e8"), units(F.col("l.q")).alias("quantity_e8"), whole(seq, 33).alias("seq")
    ).where(F.col("price_e8").isNotNull() & F.col("quantity_e8").isNotNull())
    changes = changes.withColumn("op", F.when(F.col("quantity_e8") == 0, "delete").otherwise("update"))
    return last_writer(changes, [*book, "side", "price_e8"], "seq", "op", ["quantity_e8"]).where(F.col("quantity_e8") > 0)
