from .measures import (count_if, decimalize, distinct_counts, minor_to_major,  # noqa: F401
                       sum_if, zero_major)
from .timebuckets import (in_days, local_day, local_ts, ts_lit,  # noqa: F401
                          whole_days_between)
