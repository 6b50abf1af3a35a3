from .tickets import (label_stream, read_stream, run_available_now, ticket_stream,  # noqa: F401
                      write_stream_source)
