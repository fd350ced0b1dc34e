"""DataFrame-to-DataFrame warehouse operators."""

from dayfold.operators.clean import (
    conform_types,
    latest_by_key,
    mask_columns,
    orphan_rows,
    split_valid,
    tag_rejects,
)
from dayfold.operators.dims import (
    Lookup,
    calendar_dim,
    denormalize_dim,
    scd1_upsert,
    scd2_apply,
    scd2_build,
    scd2_lookup,
)
from dayfold.operators.facts import (
    accumulating_snapshot,
    allocate_header_amount,
    periodic_snapshot,
    transaction_fact,
)
from dayfold.operators.metrics import (
    cohort_value,
    funnel,
    lifecycle,
    new_ids,
    period_growth,
    period_set_compare,
    repeat_rate,
    retention_matrix,
    rfm_segments,
    streaks,
    topk_per_group,
    transitions,
)
from dayfold.operators.quality import (
    InRange,
    InSet,
    NotNull,
    References,
    Unique,
    profile_columns,
    reconcile,
    reconcile_digests,
    rule_audit,
    volume_drift,
)
from dayfold.operators.sequence import asof_join, next_event, sessionize
from dayfold.operators.stored import scd2_apply_stored, stored_history, upsert_stored
from dayfold.operators.summaries import (
    active_bitmaps,
    active_ids,
    daily_summary,
    distinct_sketch,
    grouping_summary,
    merge_bitmaps,
    merge_quantiles,
    merge_sketch,
    period_to_date,
    pivot_summary,
    quantile_sketch,
    quantile_summary,
    to_date_merge,
    trailing_summary,
    unpivot_summary,
)

__all__ = [
    "InRange",
    "InSet",
    "Lookup",
    "NotNull",
    "References",
    "Unique",
    "accumulating_snapshot",
    "active_bitmaps",
    "active_ids",
    "allocate_header_amount",
    "asof_join",
    "calendar_dim",
    "cohort_value",
    "conform_types",
    "daily_summary",
    "denormalize_dim",
    "distinct_sketch",
    "funnel",
    "grouping_summary",
    "latest_by_key",
    "lifecycle",
    "mask_columns",
    "merge_bitmaps",
    "merge_quantiles",
    "merge_sketch",
    "new_ids",
    "next_event",
    "orphan_rows",
    "period_growth",
    "period_set_compare",
    "period_to_date",
    "periodic_snapshot",
    "pivot_summary",
    "profile_columns",
    "quantile_sketch",
    "quantile_summary",
    "reconcile",
    "reconcile_digests",
    "repeat_rate",
    "retention_matrix",
    "rfm_segments",
    "rule_audit",
    "scd1_upsert",
    "scd2_apply",
    "scd2_apply_stored",
    "scd2_build",
    "scd2_lookup",
    "sessionize",
    "split_valid",
    "stored_history",
    "streaks",
    "tag_rejects",
    "to_date_merge",
    "topk_per_group",
    "transaction_fact",
    "transitions",
    "trailing_summary",
    "unpivot_summary",
    "upsert_stored",
    "volume_drift",
]
