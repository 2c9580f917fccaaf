"""Event ingestion: envelope unwrapping, validation, enrichment, card masking and the
accepted / rejected split. All of it is built-in JSON and array expressions, so the
same functions run in a batch job and inside a streaming micro-batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import constants as C
from ledgerflow.functions.columns import mask_card, mask_card_runs

ARR = T.ArrayType(T.StringType())
# payload fields that become columns of their own
EVENT_COLUMNS = ["transaction_id", "customer_id", "merchant_id", "amount", "currency", "timestamp", "status", "channel",
                 "card_number"]


def _items(text: Column) -> Column:
    """A JSON list text becomes its elements; anything else is one element."""
    return F.when(F.json_array_length(text).isNotNull(), F.from_json(text, ARR)).otherwise(F.array(text))


def extract_events(line: Column, keys: Column | None = None) -> Column:
    """array<string> of event payloads from one message, in the order the envelopes
    are tried: Records[].body, body (object, list or JSON text), detail, a bare event
    with transaction_id, a bare list. A JSON object of another shape carries no
    events; text that is not JSON at all is kept as one (malformed) event so it is
    rejected visibly instead of vanishing. A list inside a Records body is flattened."""
    keys = F.json_object_keys(line) if keys is None else keys
    has = lambda k: F.coalesce(F.array_contains(keys, F.lit(k)), F.lit(False))
    records = F.from_json(F.get_json_object(line, "$.Records"), ARR)
    from_records = F.flatten(F.transform(records, lambda r: _items(F.get_json_object(r, "$.body"))))
    return (F.when(has("Records"), F.coalesce(from_records, F.array().cast(ARR)))
            .when(has("body"), _items(F.get_json_object(line, "$.body")))
            .when(has("detail"), F.array(F.get_json_object(line, "$.detail")))
            .when(has("transaction_id"), F.array(line))
            .when(F.json_array_length(line).isNotNull(), F.from_json(line, ARR))
            .when(keys.isNull(), F.array(line))
            .otherwise(F.array().cast(ARR)))


def unwrap(messages: DataFrame, line_col: str = "line") -> DataFrame:
    """One row per event: the message columns plus ``event_pos`` and ``payload``."""
    # the keys are asked for by every branch: a column of their own is computed once a message
    keyed = messages.withColumn("_keys", F.json_object_keys(F.col(line_col)))
    return (keyed.select("*", F.posexplode(extract_events(F.col(line_col), F.col("_keys"))).alias("event_pos", "payload"))
            .drop(line_col, "_keys"))


def _field(name: str) -> Column:
    return F.get_json_object(F.col("payload"), f"$.{name}")


def _number_text(x: Column) -> Column:
    """A double as plain decimal text, without an exponent and with one digit at least
    behind the point (-5.0, 2000000.0)."""
    plain = F.regexp_replace(x.cast(T.DecimalType(38, 6)).cast(T.StringType()), "0+$", "")
    shown = F.coalesce(F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain), x.cast(T.StringType()))
    return F.when(x.cast(T.StringType()) == "-0.0", F.lit("-0.0")).otherwise(shown)


def validation_error(required=C.EVENT_REQUIRED_FIELDS, max_amount=C.EVENT_MAX_AMOUNT) -> Column:
    """The first failing rule's message, or null. Rules in order: JSON object,
    required keys present (a present null passes), numeric amount, amount > 0,
    amount <= max, known currency (upper-cased), transaction_id of 3+ characters. The parts that several
    rules read are the columns of :func:`_parsed`."""
    keys, raw_amount = F.col("_keys"), F.col("_amount")
    missing = F.array_except(F.array(*[F.lit(f) for f in sorted(required)]), keys)
    amt = raw_amount.try_cast(T.DoubleType())
    # a JSON string or whole number is shown as it came, another number as a double
    as_text = F.col("payload").rlike(r'"amount"\s*:\s*"') | raw_amount.rlike(r"^-?\d+$")
    shown = F.when(as_text, raw_amount).otherwise(_number_text(amt))
    invalid = F.concat(F.lit("Invalid amount: "), F.coalesce(F.when(amt.isNull(), raw_amount).otherwise(shown), F.lit("None")),
                       F.lit(" — "))
    currency = F.upper(F.coalesce(F.col("_currency"), F.lit("None")))
    tid = F.coalesce(_field("transaction_id"), F.lit("None"))
    return F.coalesce(
        F.when(keys.isNull(), F.lit("Malformed event: not a JSON object")),
        F.when(F.size(missing) > 0, F.concat(F.lit("Missing required fields: "), F.array_join(missing, ", "))),
        F.when(raw_amount.isNull(), F.concat(invalid, F.lit(
            "float() argument must be a string or a real number, not 'NoneType'"))),
        F.when(amt.isNull(), F.concat(invalid, F.lit("could not convert string to float: '"), raw_amount, F.lit("'"))),
        F.when(amt <= 0, F.concat(invalid, F.lit("Invalid amount: "), _number_text(amt), F.lit(" (must be > 0)"))),
        F.when(amt > F.lit(float(max_amount)), F.concat(invalid, F.lit("Amount exceeds maximum: "), _number_text(amt))),
        F.when(~currency.isin(C.VALID_CURRENCIES), F.concat(F.lit("Invalid currency: "), currency)),
        F.when(F.length(tid) < 3, F.concat(F.lit("Invalid transaction_id: "), tid)),
    )


def _parsed(events: DataFrame) -> DataFrame:
    """The payload's keys, amount and currency, parsed once an event: as the output of a generator
    (of one row), which a filter on what follows from them is not pushed through."""
    parts = F.struct(F.json_object_keys(F.col("payload")).alias("_keys"), _field("amount").alias("_amount"), _field("currency").alias("_currency"))
    return events.select("*", F.inline(F.array(parts)))


def validate(events: DataFrame) -> DataFrame:
    return _parsed(events).withColumn("_error", validation_error()).drop("_keys", "_amount", "_currency")


def enrich(valid: DataFrame, ingested_at: Column, request_id: Column | None = None,
           environment: str = "development") -> DataFrame:
    """Typed, normalised event rows. Amount is parsed from its text straight to
    decimal(18,2) (half-up); status/channel are lower-cased with defaults; the card
    number is masked. The payload itself is not kept: fields without a column go on in
    ``extra``, JSON rebuilt without the known keys, card-like digits cut; null if none."""
    card = _field("card_number")
    rest = F.map_filter(F.from_json("payload", T.MapType(T.StringType(), T.StringType())),
                        lambda k, v: ~k.isin(*EVENT_COLUMNS))
    return valid.select(
        *[c for c in valid.columns if c not in ("payload", "_error")],
        _field("transaction_id").alias("transaction_id"),
        _field("customer_id").alias("customer_id"),
        _field("merchant_id").alias("merchant_id"),
        _field("amount").try_cast(T.DecimalType(18, 2)).alias("amount"),
        F.upper(_field("currency")).alias("currency"),
        _field("timestamp").alias("timestamp"),
        F.lower(F.coalesce(_field("status"), F.lit("pending"))).alias("status"),
        F.lower(F.coalesce(_field("channel"), F.lit("unknown"))).alias("channel"),
        mask_card(card).alias("card_number"),
        ingested_at.alias("_ingested_at"),
        (request_id if request_id is not None else F.md5(F.col("payload"))).alias("_request_id"),
        F.lit(environment).alias("_environment"),
        F.lit(C.EVENT_SOURCE_TAG).alias("_source"),
        F.when(F.size(rest) > 0, mask_card_runs(F.to_json(rest))).alias("extra"),
    )


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) — two filters of one validated frame."""
    return (validated.where(F.col("_error").isNull()).drop("_error"),
            validated.where(F.col("_error").isNotNull()))


def rejects(rejected: DataFrame, rejected_at: Column) -> DataFrame:
    """Dead-letter rows ``{event, error, timestamp}`` (always kept, never dropped), card
    numbers in the event text and in the error cut to their last four digits."""
    return rejected.select(*[c for c in rejected.columns if c not in ("payload", "_error")],
                           mask_card_runs(F.col("payload")).alias("event"),
                           mask_card_runs(F.col("_error")).alias("error"),
                           rejected_at.alias("timestamp"))


def batch_summary(validated: DataFrame, order: list[str], first_n: int = 10) -> DataFrame:
    """processed, failed and the first ``first_n`` errors in message order. The errors
    come from a top-n (each task keeps n), never from collecting all errors."""
    counts = validated.agg(F.count(F.when(F.col("_error").isNull(), 1)).alias("processed"),
                           F.count(F.when(F.col("_error").isNotNull(), 1)).alias("failed"))
    first = (validated.where(F.col("_error").isNotNull()).orderBy(*order).limit(first_n)
             .agg(F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in order], F.col("_error").alias("e"))))
                  .alias("_errs"))
             .select(F.transform("_errs", lambda x: x["e"]).alias("first_errors")))
    both = counts.unionByName(first, allowMissingColumns=True)
    return both.agg(F.max("processed").alias("processed"), F.max("failed").alias("failed"),
                    F.coalesce(F.first("first_errors", ignorenulls=True), F.array().cast(ARR)).alias("first_errors"))
