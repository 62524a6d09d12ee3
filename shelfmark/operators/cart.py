"""Carts: events folded into lines, lines nested into records.

Events are ``(cart_id, barcode, ts, event_id, action, person)``, in the order of ``(ts, event_id)``.
``add`` puts one more into the cart, or starts a line; ``inc`` and ``dec`` change a line and do nothing
without one; a line at zero is gone; ``del`` drops a line; ``submit`` takes the whole cart. Only a submit has
a person, and without one it does nothing.

The fold is associative, so one cart or line may hold any share of the events. What a run of events does
to a line is described by five numbers, the *effect* of the run:

* ``drops``: how many ``del`` it holds. With any, a line that was there before is lost.
* ``change``: by how much it moves the quantity of a line that survives it.
* ``need``: a line survives if its quantity is larger than this.
* ``qty`` and ``added_at``: the line it leaves if there was none, or if that was lost (``qty`` 0: none).

Whatever the quantity before, all lines that are lost go on alike: when the larger of two quantities is
down to zero, the smaller is too. That is why two cases are enough. Effects of consecutive runs combine
into the effect of the whole: the events of a cart first within stretches of bounded size, then over the
stretches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfmark.functions.text import iso_text, trimmed
from shelfmark.operators.numbering import STRETCH_ROWS, numbered, parts_for, ranged, spread

# No stretch of a cart's events holds many more than this. Only speed depends on it.
LARGE_CART = 1_000_000
#: Lines of a record that is still nested into one document.
NESTED_LINES = 100_000

EFFECT = ("drops", "change", "need", "qty", "added_at")


def with_stretch(events: DataFrame, large_cart: int = LARGE_CART) -> DataFrame:
    """Adds ``stretch``: which run of its cart's events, in order, an event is in.

    Events are dealt by ranges of their place in the order, so a stretch holds about half of ``large_cart`` events
    whatever times they bear; a cart of fewer lies in one or two. Lines don't touch one another, so events of one moment
    may be dealt by barcode.
    """
    known = events.where(F.col("cart_id").isNotNull())
    return ranged(known, ["cart_id", "ts", "event_id", "barcode"], "stretch", -(-large_cart // 2))


def event_effects(events: DataFrame) -> DataFrame:
    """Every line event as an effect. Other actions are left out.

    Besides the events that people cause there is ``hold``: a line as it was stored, with ``held_qty`` and
    ``held_at``. It comes before all others.
    """
    held = "held_qty" in events.columns
    qty, at = ("held_qty", "held_at") if held else ("0L", "NULL")
    return events.where("action IN ('add', 'inc', 'dec', 'del', 'hold')").selectExpr(
        "*",
        "CAST(action IN ('del', 'hold') AS BIGINT) AS drops",
        "CASE WHEN action IN ('add', 'inc') THEN 1L WHEN action = 'dec' THEN -1L ELSE 0L END AS change",
        "CAST(action = 'dec' AS BIGINT) AS need",
        f"CASE WHEN action = 'hold' THEN {qty} ELSE CAST(action = 'add' AS BIGINT) END AS qty",
        f"CASE WHEN action = 'hold' THEN {at} WHEN action = 'add' THEN ts END AS added_at",
    )


def combine_effects(effects: DataFrame, keys: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """The effects of each group of ``keys``, taken in ``order``, as one effect; worked on in so many ``parts``."""
    backwards = ", ".join(f"{column} DESC" for column in order)
    later = (
        f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {backwards} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    # Both window steps run over the same sorted rows, from the last to the first.
    after = f"coalesce(sum(change) {later}, 0)"
    seen = spread(effects.select(*keys, *order, *EFFECT), parts, *keys).selectExpr(
        *keys,
        *order,
        *EFFECT,
        f"qty + {after} AS remaining",
        f"coalesce(sum(drops) {later}, 0) > 0 AS dropped",
        # A line with this quantity or less at the end of the group was lost at this effect.
        f"need + change + {after} AS bar",
    ).selectExpr("*", f"max(bar) {later} AS later_bar")
    stays = "qty > 0 AND NOT dropped AND (later_bar IS NULL OR remaining > later_bar)"
    # The line that is there at the end was started by the earliest effect whose line stays.
    return seen.groupBy(*keys).agg(
        F.expr("sum(drops) AS drops"),
        F.expr("sum(change) AS change"),
        F.expr("greatest(max(bar) - sum(change), 0) AS need"),
        F.expr(f"coalesce(max(remaining) FILTER (WHERE {stays}), 0) AS qty"),
        F.expr(f"min(added_at) FILTER (WHERE {stays}) AS added_at"),
    )


def fold_lines(events: DataFrame, keys: list[str], parts: int | None = None) -> DataFrame:
    """The line that each group of ``keys`` holds after its last event. Events bring their stretch."""
    stretches = combine_effects(event_effects(events), [*keys, "stretch"], ["ts", "event_id"], parts)
    lines = combine_effects(stretches, keys, ["stretch"], parts)
    return lines.where(F.col("qty") > 0).select(*keys, "qty", "added_at")


def is_submit() -> Column:
    return (F.col("action") == "submit") & (trimmed("person") != "")


def with_submit(events: DataFrame, parts: int | None = None) -> DataFrame:
    """Adds ``record_id``, ``submitted_at`` and ``person``: the next submit of the cart, NULL without one.

    It is looked for in the event's own stretch first, then among the first submits of the later stretches.
    """
    stretch = ["cart_id", "stretch"]

    def after(keys: list[str], *order: str) -> WindowSpec:
        backwards = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
        return backwards.rowsBetween(Window.unboundedPreceding, -1)

    submit = F.when(is_submit(), F.struct("ts", "event_id", trimmed("person").alias("person")))
    events = spread(events, parts, *stretch).withColumn("_submit", submit)
    firsts = events.groupBy(*stretch).agg(F.min("_submit").alias("_first"))
    following = firsts.select(*stretch, F.min("_first").over(after(["cart_id"], "stretch")).alias("_far"))
    near = events.withColumn("_near", F.min("_submit").over(after(stretch, "ts", "event_id")))
    closing = F.coalesce("_near", "_far")
    held = [c for c in ("held_qty", "held_at") if c in events.columns]
    return near.join(following, stretch, "left").select(
        "cart_id",
        "barcode",
        "ts",
        "event_id",
        "action",
        "stretch",
        *held,
        closing["event_id"].alias("record_id"),
        closing["ts"].alias("submitted_at"),
        closing["person"].alias("person"),
    )


def _named(lines: DataFrame, products: DataFrame, parts: int | None = None) -> DataFrame:
    """Lines of known products with their names; of several names of a barcode the least.

    Barcodes do not touch one another, so unknown ones can go after the fold, when few rows are left.
    """
    return lines.join(spread(products, parts, "barcode").groupBy("barcode").agg(F.min("name").alias("name")), "barcode")


_RECORD = ["record_id", "cart_id", "submitted_at", "person"]


def _all_lines(events: DataFrame, large_cart: int) -> tuple[DataFrame, int | None]:
    dealt = with_stretch(events, large_cart)
    parts = parts_for(dealt.sparkSession, dealt.count())  # as stored: no row is read
    return fold_lines(with_submit(dealt, parts), [*_RECORD, "barcode"], parts), parts


def all_lines(events: DataFrame, large_cart: int = LARGE_CART) -> DataFrame:
    """The lines of all submits, and of the carts after the last one (``record_id`` NULL)."""
    return _all_lines(events, large_cart)[0]


def cart_state(events: DataFrame, products: DataFrame, large_cart: int = LARGE_CART) -> DataFrame:
    """Lines in the carts after the last event: what was not submitted."""
    lines, parts = _all_lines(events, large_cart)
    return _named(lines.where(F.col("record_id").isNull()), products, parts).select("cart_id", "barcode", "name", "qty", "added_at")


def submitted_lines(events: DataFrame, products: DataFrame, large_cart: int = LARGE_CART) -> DataFrame:
    """Lines of every submitted cart. An empty cart gives none."""
    lines, parts = _all_lines(events, large_cart)
    return _named(lines.where(F.col("record_id").isNotNull()), products, parts).select(*_RECORD, "barcode", "name", "qty", "added_at")


def cart_totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy("cart_id").agg(
        F.sum("qty").alias("total_qty"), F.count(F.lit(1)).alias("n_lines")
    )


def record_lines(lines: DataFrame, rows: int = STRETCH_ROWS) -> DataFrame:
    """Submitted lines with ``line_no``, their place in the record: the order they were added in.

    This is the form to store records in whatever their size: no task sorts more than about ``rows`` lines.
    """
    return numbered(lines, ["added_at", "barcode"], "line_no", by=["record_id"], rows=rows)


def lines_to_nest(numbered: DataFrame, most: int = NESTED_LINES) -> DataFrame:
    """Of :func:`record_lines` the lines of records with at most ``most`` lines: those fit one document.

    At most one of so many lines is the next of a larger record: few enough to broadcast.
    """
    large = numbered.where(F.col("line_no") == most + 1).select("record_id").distinct()
    return numbered.join(F.broadcast(large), "record_id", "left_anti")


def build_records(lines: DataFrame, parts: int | None = None) -> DataFrame:
    """Submitted lines nested into records, items in the order they were added: one row per submit.

    ``parts`` says into how many partitions very many lines are dealt, see :func:`numbering.parts_for`.

    A record is one document, so its items are one array. It holds a barcode once, hence never more lines than
    there are products. Ordering happens within the aggregate's own buffer of that many items.
    """
    item = F.struct("added_at", "barcode", "name", "qty")
    return spread(lines, parts, "record_id").groupBy(*_RECORD).agg(F.array_sort(F.collect_list(item)).alias("items"))


def as_records(nested: DataFrame) -> DataFrame:
    """Nested records as the documents of the record log."""
    item = F.transform(
        "items",
        lambda i: F.struct(
            i["barcode"].alias("barcode"),
            i["name"].alias("name"),
            i["qty"].alias("qty"),
            iso_text(i["added_at"]).alias("addedAt"),
        ),
    )
    return nested.select(
        F.col("record_id").cast("string").alias("id"),
        "person",
        iso_text(F.col("submitted_at")).alias("submittedAt"),
        item.alias("items"),
    )
