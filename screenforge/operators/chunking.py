"""Geometry of long texts: evenly spaced chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ScreenConfig


def geometry_sql(length: str, config: ScreenConfig) -> dict[str, str]:
    """eff (code points of a chunk), n (chunks) and stride, for a length."""
    eff = f"least({config.chunk_size}, greatest(1000, {length} div 4))"
    n = f"least({config.max_chunks}, greatest(2, {length} div {eff}))"
    return {"eff": eff, "n": n, "stride": f"({length} div {n})"}


def geometry(df: DataFrame, config: ScreenConfig, length: str = "len") -> DataFrame:
    return df.withColumns({k: F.expr(v).cast("long") for k, v in geometry_sql(length, config).items()})


def chunks(text: str, config: ScreenConfig) -> Column:
    """The chunks of a text, in order."""
    g = geometry_sql(f"length({text})", config)
    return F.expr(
        f"transform(transform(array(struct(cast({g['eff']} as int) as eff, cast({g['n']} as int) as n, cast({g['stride']} as int) as stride)), "
        f"g -> transform(sequence(0, g.n - 1), i -> substring({text}, i * g.stride + 1, g.eff))), x -> x)[0]"
    )
