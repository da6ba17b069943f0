from cartstream.functions.text import (  # noqa: F401
    composite_key, event_key, handle, is_blank, join_tags, line_name, new_event_id, non_empty, sku, split_tags,
    to_text, truthy_id, variant_title,
)
from cartstream.functions.topics import (  # noqa: F401
    TOPIC_TABLES, topic_operation, topic_table, topic_type, topics_of,
)
from cartstream.functions.values import (  # noqa: F401
    clamp_to, grams, hmac_sha256_base64, millis_to_seconds, money, money_text, payload_hash, price_text,
    published_when_active, try_ts_instant, ts_instant, ts_or_default, ts_wallclock, unix_floor,
)
