from ledgerline.functions.text import BLANK_PATTERN, QUOTED_TOKEN_PATTERN, is_blank, quoted_token
from ledgerline.functions.keys import KEY_PATTERN, parse_key
from ledgerline.functions.timefmt import SERVICE_ZONE, duration_parts, render_local, to_service_zone

__all__ = [
    "BLANK_PATTERN",
    "QUOTED_TOKEN_PATTERN",
    "is_blank",
    "quoted_token",
    "KEY_PATTERN",
    "parse_key",
    "SERVICE_ZONE",
    "duration_parts",
    "render_local",
    "to_service_zone",
]
