from .aggregates import AGGREGATES, Parts, concat, count, maximum, minimum, total
from .strings import (characters, java_hash, java_split, odd_hash, sink_line,
                      text_lines)

__all__ = ["AGGREGATES", "Parts", "concat", "count", "maximum", "minimum", "total",
           "characters", "java_hash", "java_split", "odd_hash", "sink_line",
           "text_lines"]
