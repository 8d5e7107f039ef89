"""Column-returning scalar functions."""

from panelkit.functions.dates import (calendar_columns, date_parts, month_index, month_start,
                                      period_flag, range_stem, season, weekday_mon0, year_month,
                                      ym_from_index, ym_of)
from panelkit.functions.numeric import (bucket, clean_number, clip_lower, exact_avg, exact_sum,
                                        log1p_clipped, null_nan, quantile_labels, rnd, safe_ratio,
                                        sqrt_clipped, truncating_cast)
from panelkit.functions.text import (collapse_ws, entity_key, fold_ascii, normalize_entity_name,
                                     normalize_text, slugify, title_case, url_allowed, url_host)
