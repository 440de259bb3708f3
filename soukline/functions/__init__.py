from .calendar import date_attributes
from .masking import email_mask, mask_all_pii, mask_email, mask_phone, phone_mask
from .timekeys import date_lit, parse_ts, to_usd, ts_lit, with_lineage, with_time_keys

__all__ = ["date_attributes", "email_mask", "mask_all_pii", "mask_email", "mask_phone",
           "phone_mask", "date_lit", "parse_ts", "to_usd", "ts_lit", "with_lineage",
           "with_time_keys"]
