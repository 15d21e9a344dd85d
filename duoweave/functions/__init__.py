"""Column functions (native Spark expressions only, no Python UDFs)."""

from duoweave.functions.text import (  # noqa: F401
    clean_text, is_script, language_label, script_counts,
    strip_ws, text_of,
)
from duoweave.functions.urls import (  # noqa: F401
    absolute_url, in_domain, is_valid_url, netloc, normalize_link, origin,
)
