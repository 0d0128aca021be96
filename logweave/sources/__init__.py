from .log import (append_in_order, log_from_topic, log_note, read_committed, read_log,
                  read_partition, stream_log, write_log)
from .positions import (committed_positions, running_positions, stream_lag,
                        stream_positions)
from .sink import observe_stage, text_sink
from .text import lines_prepared, read_lines, stream_lines, tokenize_lines, tokenize_text
from .text_stream import printed_lines, stream_text_sink

__all__ = ["append_in_order", "committed_positions", "lines_prepared", "log_from_topic",
           "log_note", "observe_stage", "printed_lines", "read_committed", "read_lines",
           "read_log", "read_partition", "running_positions", "stream_lag", "stream_lines",
           "stream_log", "stream_positions", "stream_text_sink", "text_sink",
           "tokenize_lines", "tokenize_text", "write_log"]
