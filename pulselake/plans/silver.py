"""Bronze -> Silver for all topics."""

from __future__ import annotations

import logging

from pulselake.operators.refine import refine, unstored
from pulselake.sources.lake import SILVER, Lake
from pulselake.sources.seals import in_batches
from pulselake.specs import TOPICS, TopicSpec

log = logging.getLogger(__name__)


def refine_topic(lake: Lake, spec: TopicSpec, *, after_batch: int | None = None, new_only: bool = False,
                 append_only_intraday: bool = False) -> bool:
    """Bring one Silver table up to date; False when its Bronze is missing.

    ``new_only`` reads the batches that landed since the last run, for every
    stream, so that a daily run reads a day and not the whole history. Without
    it all of Bronze is read, and every key already stored is skipped by its envelope.
    Either way the run is recorded. The sealed batches are listed first and
    only those are read, so a batch that lands meanwhile, or is half there,
    belongs to the next run. ``after_batch`` reads newer batches only and records nothing.
    ``append_only_intraday`` appends intraday deliveries without looking at
    stored rows.
    """
    newest = lake.newest_batches(spec.name)
    bronze = lake.read_bronze(spec.name, after_batch, newest)
    if bronze is None:
        log.info("%s: no Bronze table, skipped", spec.name)
        return False
    if after_batch is None:
        done = lake.refined_batches(spec.name) if new_only else {}
        if all(n <= done.get(s, -1) for s, n in newest.items()):
            return True
        bronze = bronze.filter(in_batches(done, newest))
    if spec.intraday and append_only_intraday:
        lake.append(refine(bronze, spec, unique=False), SILVER, spec.name)
    else:
        # A re-delivered event repeats its timestamp and date, so only the
        # dates of this input need comparing. Profiles are keyed by user alone.
        dates = bronze.select("event_date") if "event_timestamp" in spec.keys else None
        stored = None if new_only or after_batch is not None else lake.read(SILVER, spec.name)
        if stored is not None:
            bronze = unstored(bronze, stored, spec)  # most of Bronze, unless the run is the first
        lake.insert_only(refine(bronze, spec), SILVER, spec.name, spec.keys, dates)
    if after_batch is None:
        lake.note_refined(spec.name, newest)
    return True


def run_silver(lake: Lake, **options) -> list[str]:
    """Refine every topic that has Bronze rows; names of the tables written."""
    return [spec.name for spec in TOPICS.values() if refine_topic(lake, spec, **options)]
