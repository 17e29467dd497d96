from voltframe.functions.timeindex import (  # noqa: F401
    serial_index, index_to_utc, index_to_local, to_local, hour_ending, sample_minutes,
    weekend_flag, local_wall_instants, LOCAL_TZ, MAX_INDEX)
from voltframe.functions.text import (  # noqa: F401
    parse_local_datetime, event_id, program_id, year_month, strip_caps_to_double,
    to_double, pct_difference)
from voltframe.functions.holidays import us_holidays, holiday_flag  # noqa: F401
