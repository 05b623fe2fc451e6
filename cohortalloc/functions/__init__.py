from cohortalloc.functions.expressions import (  # noqa: F401
    COMPLETE,
    INCOMPLETE,
    PASSING_GRADES,
    clean_model_id,
    completeness_flag,
    downgrade_if_null,
    pad_class_number,
    passing_grade,
    round_half_even,
    round_half_up,
    safe_ratio,
    strict_concat,
    strip_final_marker,
    sum_propagate_nulls,
    sum_skip_nulls,
)
