"""Table operators: config steps, keyed merge, top-k."""

from quarry.operators.merge import (  # noqa: F401
    DuplicateSourceKeyError,
    merge_changes,
    plan_merge,
    profile_source,
)
from quarry.operators.steps import DATAFRAME_METHODS, STEPS, StepError, apply_steps  # noqa: F401
from quarry.operators.topk import top_k, top_k_per_group  # noqa: F401
