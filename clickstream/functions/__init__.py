from clickstream.functions.parse import identified, malformed, parse_log, typed, valid
from clickstream.functions.text import recode
from clickstream.functions.timerange import between_times

__all__ = ["between_times", "identified", "malformed", "parse_log", "recode", "typed", "valid"]
