"""Column expressions: every function takes and returns ``Column`` objects."""

from .codes import (  # noqa: F401
    MOVEMENT_LABELS,
    RECEIPT_LABELS,
    balance_status,
    class_only,
    classify_receipt,
    default_status,
    line_status,
    movement_label,
    override_status,
    production_status,
    status_by_type,
)
from .dates import (  # noqa: F401
    age_bucket,
    age_years,
    cutoff_calendar,
    date_plus_hhmm,
    mask_after,
    to_ts,
)
from .numbers import clean_number, net_layer_qty, snap_zero, to_key  # noqa: F401
from .predicates import (  # noqa: F401
    alive,
    as_of,
    item_prefix,
    keep_not_in,
    outer_side_cutoff,
    voided_or_missing,
)
from .values import blank_to_null, coalesce_chain, prefix_key, replace_when, text_value  # noqa: F401
