"""Warehouse set-up: empty tables of the declared schemas plus the Unknown member."""

from __future__ import annotations

from tidemark import schemas
from tidemark.operators import scd
from tidemark.plans.publish import Manifest, Warehouse


def initialise(wh: Warehouse, run_id: str = "init") -> Manifest:
    """Seed the Unknown member of an empty warehouse; a table without rows reads as an
    empty frame of its declared schema."""
    base = wh.manifest()
    if base.written("dim_customer"):
        return base
    return wh.commit(wh.append(base, "dim_customer", scd.unknown_member(wh.spark), run_id), run_id, {"max_sk": str(schemas.UNKNOWN_SK)})
