from tidewater.functions.dates import (add_days, day_start, day_start_millis, epoch_millis,
                                      format_date, parse_date)
from tidewater.functions.keys import (day_prefixes, id_text, item_key, parse_column_defaults,
                                     parse_column_list, salted_row_key)

__all__ = ["add_days", "day_start", "day_start_millis", "epoch_millis", "format_date",
           "parse_date", "day_prefixes", "id_text", "item_key", "parse_column_defaults",
           "parse_column_list", "salted_row_key"]
