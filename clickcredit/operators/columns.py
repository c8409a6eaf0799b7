"""Column names used across the operators."""

# hit columns (input)
HIT_TIME = "hit_time_gmt"
IP = "ip"
USER_AGENT = "user_agent"
EVENT_LIST = "event_list"
PRODUCT_LIST = "product_list"
REFERRER = "referrer"

# derived hit columns
HIT_TS = "hit_ts"
DOMAIN = "domain"
KEYWORD = "keyword"
IS_PURCHASE = "is_purchase"
REVENUE = "revenue"
GAP = "gap"
SESSION_ID = "session_id"

HIT_INPUT_COLUMNS = (HIT_TIME, USER_AGENT, IP, EVENT_LIST, PRODUCT_LIST, REFERRER)

# report columns
REPORT_DOMAIN = "Search Engine Domain"
REPORT_KEYWORD = "Search Keyword"
REPORT_REVENUE = "Revenue"
