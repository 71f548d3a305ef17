"""The visit map job as one lazy plan.

Physical shape of the scheduled run (customer-side window; see ``docs/PLANS.md``)::

    scan cus (window pushed, 5 cols) --------------------------------------\
                                                                            join on conversation_id
    scan msg (5 cols [+ window], bloom-filtered by the windowed cus keys)  /
      -> partial distinct -> shuffle -> distinct ----------------------------/
      -> contact key -> explode_outer -> partial distinct -> shuffle -> distinct
      -> report date, build stamp (projections, no shuffle)

Design points, all for the large-cluster case:

* One row-level dedupe after the explode, not one before and one after
  (dedupe(explode(dedupe(x))) == dedupe(explode(x))), so the wide exploded rows
  cross the network once.
* ``prededupe`` removes copies inside an input before the join. The output is
  deduped anyway, so this is exact at any setting. A dedupe is a partial
  aggregate in the map task first, so copies are dropped before they are
  shuffled, and a key whose rows are copies (say a third of a table) meets
  the other side once per distinct row, not once per copy.

  ``"both"`` dedupes both inputs: the join then never meets a copy, so even a
  key that is hot on both sides produces only distinct output pairs.
  ``"messaging"`` leaves the customer side as a plain filtered scan on
  purpose: that is the side Spark builds its runtime bloom filter from, and
  an aggregate there stops Spark from injecting it. With the filter, the
  scheduled run (11 days of customers against all messaging history) drops
  messaging rows of other conversations inside the scan, before any
  shuffle. Customer copies of a hot key then meet already-distinct messaging
  rows, so the work stays linear unless the same key also has many distinct
  messaging rows; AQE splits the hot partition and the partial dedupe after
  the join collapses the copies map-side.

  The default, ``"auto"``, picks ``"messaging"`` exactly when that filter can
  apply (a customer-side window with ``sides="left"``) and ``"both"``
  otherwise (no window, or both sides windowed).
* No fixed partition count and no broadcast hint: AQE sizes shuffle partitions
  from measured bytes, converts the join to a broadcast only below its
  runtime threshold, and splits skewed join partitions.
* The build stamp is added after the dedupe: one literal per run, so it can
  neither split nor merge rows.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from visitmap.functions.window import DateWindow
from visitmap.operators.dedupe import dedupe
from visitmap.operators.explode import explode_ids
from visitmap.operators.link import link
from visitmap.operators.project import project_contract
from visitmap.operators.stamp import add_build_stamp, add_report_date
from visitmap.plans.layout import MessagingLayout, link_layout
from visitmap.plans.slice import write_slice
from visitmap.session import bloom_filter_conf
from visitmap.sources.tables import scan_customer, scan_messaging

SIDES = ("left", "both")
PREDEDUPE = ("auto", "messaging", "both", "none")


def build_visit_map(
    cus: DataFrame | str,
    msg: DataFrame | str | MessagingLayout,
    window: DateWindow | None = None,
    *,
    sides: str = "left",
    build_ts: datetime | date | str | None = None,
    prededupe: str | bool = "auto",
    spark: SparkSession | None = None,
) -> DataFrame:
    """The 10-column visit map for conversations ending in ``window``.

    ``sides="left"`` windows the customer side only (the scheduled script);
    ``"both"`` also windows messaging on its own end date (the class version).
    The two give different results when a conversation's messaging row ends
    outside the window. A ``MessagingLayout`` holds no end dates, so it goes with ``"left"``.
    """
    if sides not in SIDES:
        raise ValueError(f"sides must be one of {SIDES}, not {sides!r}")
    if isinstance(prededupe, bool):
        prededupe = "both" if prededupe else "none"
    if prededupe not in PREDEDUPE:
        raise ValueError(f"prededupe must be one of {PREDEDUPE}, not {prededupe!r}")
    if prededupe == "auto":
        prededupe = "messaging" if (window is not None and sides == "left") else "both"
    laid_out = isinstance(msg, MessagingLayout)
    if laid_out and sides == "both":
        raise ValueError("a messaging layout holds no end dates: sides must be 'left'")
    c = scan_customer(cus, window, spark)
    if prededupe == "both":
        c = dedupe(c)
    if laid_out:
        linked = link_layout(c, msg, prededupe != "none")
    else:
        m = scan_messaging(msg, window if sides == "both" else None, spark)
        linked = link(c, dedupe(m) if prededupe != "none" else m)
    return (
        linked
        .transform(explode_ids)
        .transform(dedupe)
        .transform(add_report_date)
        .transform(lambda df: add_build_stamp(df, build_ts))
        .transform(project_contract)
    )


def scheduled_visit_map(
    spark: SparkSession,
    cus: DataFrame | str,
    msg: DataFrame | str | MessagingLayout,
    window: DateWindow,
    *,
    sides: str = "left",
    build_ts: datetime | date | str | None = None,
    prededupe: str | bool = "auto",
) -> tuple[DataFrame, dict[str, str]]:
    """The visit map over a written slice of the window, and the settings to run it under.

    The settings size the runtime filter for the slice's exact number of rows (one
    a conversation, or a little more). They matter when the plan is made, so apply them
    (``session.apply``) around the action. A layout is read for the slice's conversations alone.
    """
    rows, count = write_slice(spark, cus, window)
    if isinstance(msg, MessagingLayout):
        msg = msg.for_slice(rows)
    return build_visit_map(rows, msg, window, sides=sides, build_ts=build_ts, prededupe=prededupe, spark=spark), bloom_filter_conf(count)
