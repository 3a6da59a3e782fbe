"""Raw events to typed events: one VARIANT parse per message, then typed reads of it."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import canonical
from tidemark.functions.text import is_symbol
from tidemark.schemas import CHECKED_STREAMS, TYPED, TYPED_STREAMS, WRITER_GROUPS

_DEPTH, _SNAPSHOT, _TRADES = ("depth", "rpi_depth"), ("depth_snapshot", "rpi_depth_snapshot"), ("agg_trade", "trade")

#: The event name that a stream's payload must carry. Fixed values.
EVENT_NAMES = {
    "depth": "depthUpdate", "rpi_depth": "depthUpdate", "book_ticker": "bookTicker", "agg_trade": "aggTrade", "trade": "trade",
    "mark_price": "markPriceUpdate", "force_order": "forceOrder", "contract_info": "contractInfo",
}

#: column -> (kind, streams, JSON path). Kinds: int, int? (may be missing), bool, text, and decimals:
#: dec (above zero), dec0 (zero allowed), dec± (any sign), dec? (zero allowed, may be missing). Fixed values.
FIELDS: dict[str, list[tuple[str, tuple[str, ...], str]]] = {
    "exchange_event_time_ms": [
        ("int", (*_DEPTH, "book_ticker", *_TRADES, "mark_price", "force_order", "contract_info"), "$.E"),
        ("int?", _SNAPSHOT, "$.E"), ("int", ("open_interest",), "$.time"), ("int", ("clock_sample",), "$.serverTime"),
    ],
    "exchange_transaction_time_ms": [("int", (*_DEPTH, "book_ticker", *_TRADES), "$.T"), ("int?", _SNAPSHOT, "$.T"), ("int", ("force_order",), "$.o.T")],
    "update_id": [("int", ("book_ticker",), "$.u")],
    "first_update_id": [("int", _DEPTH, "$.U")],
    "final_update_id": [("int", _DEPTH, "$.u")],
    "previous_final_update_id": [("int", _DEPTH, "$.pu")],
    "last_update_id": [("int", _SNAPSHOT, "$.lastUpdateId")],
    "trade_id": [("int", ("trade",), "$.t")],
    "aggregate_trade_id": [("int", ("agg_trade",), "$.a")],
    "first_trade_id": [("int", ("agg_trade",), "$.f")],
    "last_trade_id": [("int", ("agg_trade",), "$.l")],
    "price": [("dec", _TRADES, "$.p"), ("dec0", ("force_order",), "$.o.p")],
    "quantity": [("dec", _TRADES, "$.q"), ("dec", ("force_order",), "$.o.q")],
    "non_rpi_quantity": [("dec?", ("agg_trade",), "$.nq")],
    "buyer_is_maker": [("bool", _TRADES, "$.m")],
    "bid_price": [("dec", ("book_ticker",), "$.b")],
    "bid_quantity": [("dec0", ("book_ticker",), "$.B")],
    "ask_price": [("dec", ("book_ticker",), "$.a")],
    "ask_quantity": [("dec0", ("book_ticker",), "$.A")],
    "mark_price": [("dec", ("mark_price",), "$.p")],
    "index_price": [("dec", ("mark_price",), "$.i")],
    "estimated_settle_price": [("dec0", ("mark_price",), "$.P")],
    "funding_rate": [("dec±", ("mark_price",), "$.r")],
    "next_funding_time_ms": [("int", ("mark_price",), "$.T")],
    "open_interest": [("dec0", ("open_interest",), "$.openInterest")],
    "side": [("text", ("force_order",), "$.o.S")],
    "order_type": [("text", ("force_order",), "$.o.o")],
    "time_in_force": [("text", ("force_order",), "$.o.f")],
    "order_status": [("text", ("force_order",), "$.o.X")],
    "average_price": [("dec0", ("force_order",), "$.o.ap")],
    "last_filled_quantity": [("dec0", ("force_order",), "$.o.l")],
    "accumulated_filled_quantity": [("dec0", ("force_order",), "$.o.z")],
    "contract_type": [("text", ("contract_info",), "$.ct")],
    "delivery_date_ms": [("int", ("contract_info",), "$.dt")],
    "onboard_date_ms": [("int", ("contract_info",), "$.ot")],
    "contract_status": [("text", ("contract_info",), "$.cs")],
    "bids": [("levels", _DEPTH, "$.b"), ("levels", _SNAPSHOT, "$.bids")],
    "asks": [("levels", _DEPTH, "$.a"), ("levels", _SNAPSHOT, "$.asks")],
}


_NUMBER = r"([0-9][0-9_]*\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
#: What decimals of each kind look like; above zero means a digit other than 0 before any exponent.
_ALLOWED = {"dec": r"^\s*\+?(?=[0_.]*[1-9])" + _NUMBER, "dec0": r"^\s*(\+?|-(?=[0_.]*([eE]|\s*$)))" + _NUMBER, "dec±": r"^\s*[+-]?" + _NUMBER}
_ALLOWED["dec?"] = _ALLOWED["dec0"]
# spelt canonically already: at most six zeros behind the point come before a digit
_FEW = r"(?!0\.000000[0-9])(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?"
#: Canonical text of each kind, which nearly all numbers have.
_PLAIN = {"dec": r"(?=[0.]*[1-9])" + _FEW, "dec0": _FEW, "dec?": _FEW, "dec±": r"-?(?=[0.]*[1-9]|.*+(?<!-0))" + _FEW}
_PLAIN_LEVEL = f"^{_PLAIN['dec']}[|]{_PLAIN['dec0']}$"


def _sign(text: Column) -> Column:
    """1, 0 or -1 by the text of a number; null where there is none."""
    zero = text.rlike(r"^\s*[+-]?[0._]+([eE].*)?$")
    return F.when(text.isNull(), None).when(zero, 0).when(text.rlike(r"^\s*-"), -1).otherwise(1)


def _levels(raw: Column) -> Column:
    """Levels as structs, null unless all are fine; ``raw`` has arrays of texts."""
    plain = F.forall(raw, lambda x: F.coalesce((F.size(x) >= 2) & F.concat_ws("|", F.get(x, 0), F.get(x, 1)).rlike(_PLAIN_LEVEL), F.lit(False)))
    fine = F.forall(raw, lambda x: F.coalesce((F.size(x) >= 2) & (_sign(F.get(x, 0)) == 1) & (_sign(F.get(x, 1)) >= 0), F.lit(False)))
    spelt = F.when(plain, raw).when(fine, F.transform(raw, lambda x: F.transform(F.slice(x, 1, 2), canonical)))
    return F.transform(spelt, lambda x: F.struct(F.get(x, 0).alias("price"), F.get(x, 1).alias("quantity")))


def parsed(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed rows of raw events, with ``error``: why a message could not be typed, else null.

    Streams that only are checked give a row only where the check fails. Each payload is parsed
    once into a VARIANT and all its scalar fields are read from it at once, as one struct of texts;
    each column takes the field of the row's stream. An
    unreadable field or one that breaks its sign rule, a missing symbol (only clock samples need
    none), a wrong event name, an unknown stream and JSON that is none are errors. Values of a row
    with an error are not to be relied on. ``keep`` are further columns of the raw rows to carry along.
    """
    # streams that are only checked apart: a filter on the error would have it computed twice for all
    checked = raw.where(~F.coalesce(F.col("stream_type").isin(*TYPED_STREAMS), F.lit(False)))
    return _typed_rows(raw.where(F.col("stream_type").isin(*TYPED_STREAMS)), keep).unionByName(_checked_rows(checked, keep))


def _checked_rows(raw: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Rows of other than typed streams whose payload is not what it should be."""
    stream = F.col("stream_type")
    src = raw.withColumn("__k", F.schema_of_variant(F.try_parse_json(F.col("payload_bytes").cast("string"))))
    error = (
        F.when(~F.coalesce(stream.isin(*CHECKED_STREAMS), F.lit(False)), "unknown stream").when(F.col("__k").isNull(), "no JSON")
        .when((stream == "market_tickers") & ~F.col("__k").startswith("ARRAY"), "no array").when(~stream.isin("market_tickers", "unknown") & ~F.col("__k").startswith("OBJECT"), "no object")
    )
    fixed = {"schema_version": F.lit(1), "exchange_symbol": F.upper("exchange_symbol"), "is_duplicate": F.lit(False)}
    out = [fixed.get(f.name, F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TYPED]
    return src.select(*out, error.alias("error"), *keep).where("error is not null")


def _shape() -> tuple[str, str, dict[str, str]]:
    """All scalar fields of payloads as one struct: its type by name, its type by place, and each path's place.

    Names that differ in case only cannot be told apart by name in SQL, so fields are renamed by place.
    """
    paths = sorted({p[2:] for sources in FIELDS.values() for kind, _, p in sources if kind != "levels"} | {"e", "s", "o.s"})
    top, inner = [p for p in paths if "." not in p], [p[2:] for p in paths if p.startswith("o.")]
    named = ",".join(f"`{p}`:string" for p in top) + ",`o`:struct<" + ",".join(f"`{p}`:string" for p in inner) + ">"
    placed = ",".join(f"t{i}:string" for i in range(len(top))) + ",o:struct<" + ",".join(f"i{i}:string" for i in range(len(inner))) + ">"
    at = {f"$.{p}": f"__x.t{i}" for i, p in enumerate(top)} | {f"$.o.{p}": f"__x.o.i{i}" for i, p in enumerate(inner)}
    return f"struct<{named}>", f"struct<{placed}>", at


def _typed_rows(raw: DataFrame, keep: Sequence[str]) -> DataFrame:
    d, text = F.col("__d"), F.col("payload_bytes").cast("string")
    src = raw.withColumn("__v", F.try_parse_json(text)).withColumn("__d", F.coalesce(F.try_variant_get("__v", "$.data", "variant"), F.col("__v")))
    named, placed, at = _shape()
    kept = [c for c in raw.columns if c != "payload_bytes"]
    levels = {n: F.expr("case " + " ".join(f"when stream_type in ({_quoted(streams)}) then try_variant_get(__d, '{path}', 'array<array<string>>')" for _, streams, path in FIELDS[n]) + " end") for n in ("bids", "asks")}
    src = src.select(
        *kept,
        F.try_variant_get(d, "$", named).cast(placed).alias("__x"),
        F.to_json(d).alias("__j"),
        F.when(F.col("__v").isNull(), "no JSON").when(~F.ltrim(text).startswith("{"), "no object").alias("__k"),
        # never negative; a filter on the error must not be moved below this step, or all is read twice
        F.monotonically_increasing_id().alias("__n"),
        *[c.alias(f"__{n}") for n, c in levels.items()],
    )
    read = [F.expr("case " + " ".join(f"when stream_type in ({_quoted(streams)}) then {at[path]}" for _, streams, path in sources) + " end").alias(f"__x_{n}") for n, sources in FIELDS.items() if n not in levels]
    symbol = F.expr(f"upper(coalesce(nullif(exchange_symbol, ''), {at['$.s']}, {at['$.o.s']}))")
    src = src.withColumn("__sides", F.transform(F.array(*[f"__{n}" for n in levels]), _levels))
    src = src.select(*kept, "__j", "__k", "__n", *[F.get("__sides", F.lit(i)).alias(f"__x_{n}") for i, n in enumerate(levels)], *read, F.expr(at["$.e"]).alias("__e"), symbol.alias("__y"))
    # one pattern over all decimals of a row settles what nearly all rows are: canonical and allowed
    kinds = {n: sources[0][0] for n, sources in FIELDS.items() if sources[0][0].startswith("dec")}
    groups = [[f"__x_{n}" for n, k in kinds.items() if k in g] for g in (("dec",), ("dec0", "dec?"), ("dec±",))]
    row = "".join(f"(?:{p}(?:[|]{p})*+)?/" for p in (_PLAIN["dec"], _PLAIN["dec0"], _PLAIN["dec±"]))
    src = src.withColumn("__p", F.concat(*[part for g in groups for part in (F.concat_ws("|", *g), F.lit("/"))]).rlike(f"^{row}$"))
    src = src.withColumn("__c", F.when(~F.col("__p"), F.transform(F.array(*[f"__x_{n}" for n in kinds]), canonical)))

    # what a row of each stream has when nothing is wrong with it; rows that differ are looked at one field at a time
    scalars = [n for n in FIELDS if n not in levels]
    whole = [n for n in scalars if FIELDS[n][0][0] == "int"]
    needed = {s: sum(1 for sources in FIELDS.values() for kind, streams, _ in sources if s in streams and not kind.endswith("?")) for s in TYPED_STREAMS}
    count = lambda xs: "+".join(f"int({x})" for x in xs)
    optional = [n for n, sources in FIELDS.items() if sources[0][0].endswith("?")]
    there = [f"__x_{n} in ('true', 'false')" if FIELDS[n][0][0] == "bool" else f"__x_{n} is not null" for n in FIELDS if n not in optional]
    names = _map({s: f"'{EVENT_NAMES[s]}'" if s in EVENT_NAMES else "null" for s in TYPED_STREAMS})
    src = src.withColumns({f"__i_{n}": F.expr(f"try_cast(__x_{n} as bigint)") for n in whole} | {"__m": F.expr(f"element_at({names}, stream_type)")})
    fine = (
        f"__k is null and __p and (stream_type = 'clock_sample' or coalesce(__y, '') <> '') and startswith(__j, '{{') and (__m is null or __e <=> __m)"
        f" and {count(f'__x_{n} is null' for n in whole)} = {count(f'__i_{n} is null' for n in whole)} and {count(there)} = element_at({_map(needed)}, stream_type)"
    )
    # the lambda is not part of the generated code, which stays small enough to be compiled
    given = [*[f"__x_{n}" for n in FIELDS], "__k", "__p", "__y", "__e", "__m", "__j", "stream_type"]
    src = src.withColumn("__g", F.expr(f"case when not coalesce({fine}, false) then transform(array(struct({', '.join(given)})), r -> {_complaint()})[0] end"))
    columns: dict[str, str] = {}
    for name, sources in FIELDS.items():
        x = f"__x_{name}"
        of = {"int": f"__i_{name}", "bool": f"{x} = 'true'", "text": x, "levels": x}
        columns[name] = of.get(sources[0][0], f"if(__p, {x}, __c[{list(kinds).index(name) if name in kinds else 0}])")
    error = F.when(F.col("__n") < 0, "no place").otherwise(F.col("__g"))
    columns |= {"schema_version": "1", "exchange_symbol": "__y", "payload_hash": "unhex(sha2(__j, 256))", "is_duplicate": "false"}
    out = [F.expr(f"cast({columns.get(f.name, f.name if f.name in kept else 'null')} as {f.dataType.simpleString()})").alias(f.name) for f in TYPED]
    return src.select(*out, error.alias("error"), *keep)


def _complaint() -> str:
    """SQL: what is wrong with a row ``r``, null if nothing is."""
    tests = ["when r.__k is not null then r.__k when not startswith(r.__j, '{') then 'no object' when r.stream_type <> 'clock_sample' and coalesce(r.__y, '') = '' then 'no symbol'"]
    tests.append("when r.__m is not null and not r.__e <=> r.__m then concat('event is not ', r.__m)")
    for name, sources in FIELDS.items():
        x = f"r.__x_{name}"
        for kind, streams, _ in sources:
            fits = f"{x} is not null"
            if kind.startswith("int"):
                fits = f"try_cast({x} as bigint) is not null"
            elif kind == "bool":
                fits = f"{x} in ('true', 'false')"
            elif kind in _ALLOWED:
                pattern = _ALLOWED[kind].replace("\\", "\\\\")
                fits = f"{x} is not null and (r.__p or {x} rlike '{pattern}')"
            tests.append(f"when r.stream_type in ({_quoted(streams)}) and not coalesce({f'{x} is null or ' if kind.endswith('?') else ''}{fits}, false) then 'bad {name}'")
    return "case " + " ".join(tests) + " end"


def _map(values: dict[str, object]) -> str:
    return "map(" + ", ".join(f"'{k}', {v}" for k, v in values.items()) + ")"


def _quoted(names: Iterable[str]) -> str:
    return ", ".join(f"'{n}'" for n in names)


def typed_events(raw: DataFrame) -> DataFrame:
    """Typed rows of raw events; the first message that cannot be typed ends the job with its error."""
    rows = parsed(raw)
    why = F.concat_ws(" ", F.lit("message"), F.col("connection_id"), F.col("receive_seq").cast("string"), F.col("error"))
    checked = rows.withColumn("schema_version", F.when(F.col("error").isNull(), F.col("schema_version")).otherwise(F.raise_error(why).cast("smallint")))
    return checked.select(*TYPED.names)


def violations(raw: DataFrame) -> DataFrame:
    """Raw rows that break a rule of the feed, with ``rule``: one row per rule broken."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    rules = {
        "schema_version": ~F.col("schema_version").eqNullSafe(F.lit(1)),
        "exchange_symbol": F.col("exchange_symbol").isNotNull() & ~is_symbol("exchange_symbol"),
        "identity": empty("collector_id") | empty("boot_id") | empty("segment_id"),
        "connection_id": empty("connection_id"),
        "receive_seq": F.coalesce(F.col("receive_seq"), F.lit(0)) < 1,
        "receive_time": F.coalesce(F.least("app_receive_realtime_ns", "app_receive_monotonic_ns"), F.lit(-1)) < 0,
        "payload": F.coalesce(F.octet_length("payload_bytes"), F.lit(0)) == 0,
        "request": F.col("request_id").isNull() != F.col("request_realtime_ns").isNull(),
    }
    broken = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    return raw.withColumn("rule", F.explode(broken))


def writer_group(stream: Column | str) -> Column:
    """The group of files that a stream is written to."""
    stream = F.col(stream) if isinstance(stream, str) else stream
    out = F.lit("metadata")
    for group, streams in WRITER_GROUPS.items():
        out = F.when(stream.isin(*streams), group).otherwise(out)
    return out


def classify_frame(text: Column) -> Column:
    """What a received frame is: ``control`` (has a result or an error and an id), its event name's stream, or ``unknown``."""
    v = F.try_parse_json(text)
    get = lambda p: F.try_variant_get(v, p, "string")
    event = F.coalesce(get("$.data.e"), get("$.e"))
    rpi = F.coalesce(get("$.stream"), F.lit("")).contains("rpi")
    out = F.lit("unknown")
    for s, name in EVENT_NAMES.items():
        if s != "rpi_depth":
            out = F.when(event == name, F.lit(s)).otherwise(out)
    out = F.when((event == "depthUpdate") & rpi, F.lit("rpi_depth")).otherwise(out)
    control = get("$.id").isNotNull() | F.try_variant_get(v, "$.result", "variant").isNotNull()
    return F.when(v.isNull(), "invalid").when(event.isNull() & control, "control").otherwise(out)
