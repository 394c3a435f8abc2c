from attrix.streaming.feature_stream import (  # noqa: F401
    read_event_stream,
    upsert_stream,
    usage_features,
)
