"""DataFrame operators: cleaning, star joins, quality, profiling, ranking."""

from tallystar.operators.clean import (  # noqa: F401
    code_below,
    dedup_first,
    drop_totals,
    harmonise_values,
    keep_positive,
    key_slice,
    not_total,
    positive_measure,
    trim_columns,
)
from tallystar.operators.profile import (  # noqa: F401
    cell,
    describe,
    distinct_counts,
    distinct_values,
    head,
    null_counts,
    sample_by_key,
    sample_n,
    sample_rows,
    tail,
)
from tallystar.operators.quality import (  # noqa: F401
    assert_passed,
    domain_report,
    duplicate_report,
    quality_report,
    reconcile,
)
from tallystar.operators.rank import rank_within  # noqa: F401
from tallystar.operators.star import (  # noqa: F401
    conform,
    coverage,
    coverage_keys,
    decode,
    except_keys,
    key_unique,
    resolve_duplicates,
    union_all,
    unique_rows,
)
