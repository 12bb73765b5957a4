"""Lazy chain of the layers, built once per raw DataFrame.

Each property is a DataFrame (a logical plan); nothing runs until an action. Callers that
reuse a layer across several actions should materialise it (see plans/pipeline.py) rather
than recompute it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from cellscope.operators import curated, serving, staging


class Layers:
    """The model's layers over one raw DataFrame."""

    def __init__(self, raw: DataFrame, keep_flags: tuple[str, ...] = ()):
        self.raw = raw
        self.keep_flags = keep_flags

    @cached_property
    def stg(self) -> DataFrame:
        return staging.stg_network_events(self.raw, self.keep_flags)

    @cached_property
    def valid(self) -> DataFrame:
        return staging.stg_valid(self.stg)

    @cached_property
    def rejected(self) -> DataFrame:
        return staging.stg_rejected(self.stg)

    @cached_property
    def voice(self) -> DataFrame:
        return curated.fct_voice_call(self.valid)

    @cached_property
    def data(self) -> DataFrame:
        return curated.fct_data_session(self.valid)

    @cached_property
    def dim_cell(self) -> DataFrame:
        return curated.dim_cell_site(self.valid)

    @cached_property
    def dim_sub(self) -> DataFrame:
        return curated.dim_subscriber(self.valid)

    @cached_property
    def ref(self):
        """E1, resolved once for every serving query of this chain."""
        return serving.reference_time_value(self.voice, self.data)

    def reference_time(self):
        return self.ref

    def ranking(self) -> DataFrame:
        return serving.cell_quality_ranking(self.voice, self.data, self.dim_cell, self.ref)

    def churn(self) -> DataFrame:
        # only the current plan is joined: the latest event's plan, no full history needed
        return serving.churn_signals(self.voice, self.data, self.dim_cell,
                                     curated.current_plans(self.valid), self.ref)
