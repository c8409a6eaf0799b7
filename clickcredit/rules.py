"""Rule set for search-referrer attribution.

Every operator takes its rules as plain arguments; ``Rules`` bundles the
defaults. Nothing is read from files: a caller who wants other engines or
parameters builds another ``Rules``.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values -----------------------------------------------------------
# These must equal the rule set of the original tool for identical reports.
# Search engine names, matched as substrings of the referrer host, in order:
DEFAULT_ENGINES = ("google", "bing", "yahoo", "duckduckgo", "msn", "ask", "aol")
# Query parameters that carry the keyword, tried in order:
DEFAULT_KEYWORD_PARAMS = ("q", "p", "query", "search")
# The shop's own domain:
DEFAULT_SITE_DOMAIN = "esshopzilla.com"
# Inactivity that ends a session, in seconds (a gap must be strictly larger):
DEFAULT_TIMEOUT_SECONDS = 1800
# Event code of a purchase in the comma-separated event list:
PURCHASE_EVENT = "1"
# Suffix of the dated report name, ``YYYY-mm-dd_<suffix>``:
REPORT_NAME_SUFFIX = "SearchKeywordPerformance.tab"
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Rules:
    """Engines, keyword parameters, site domain, timeout and purchase code."""

    engines: tuple[str, ...] = DEFAULT_ENGINES
    keyword_params: tuple[str, ...] = DEFAULT_KEYWORD_PARAMS
    site_domain: str = DEFAULT_SITE_DOMAIN
    timeout_seconds: int = DEFAULT_TIMEOUT_SECONDS
    purchase_event: str = PURCHASE_EVENT

    def __post_init__(self) -> None:
        if not self.engines:
            raise ValueError("at least one search engine name is needed")
        if not self.keyword_params:
            raise ValueError("at least one keyword parameter is needed")
        if int(self.timeout_seconds) != self.timeout_seconds or self.timeout_seconds < 0:
            raise ValueError("timeout_seconds must be a non-negative whole number")

    def with_timeout(self, seconds: int) -> "Rules":
        return Rules(self.engines, self.keyword_params, self.site_domain,
                     int(seconds), self.purchase_event)


DEFAULT_RULES = Rules()
