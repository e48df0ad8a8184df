from gridloom.functions.dates import format_date, relative_minutes
from gridloom.functions.rates import format_pct, rate
from gridloom.functions.text import (
    clean_ascii,
    is_blank,
    light_normalize,
    normalize,
    normalize_py,
    safe_name,
    strip,
)

__all__ = [
    "clean_ascii", "format_date", "format_pct", "is_blank", "light_normalize", "normalize",
    "normalize_py", "rate", "relative_minutes", "safe_name", "strip",
]
