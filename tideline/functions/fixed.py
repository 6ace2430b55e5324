"""Fixed values that results depend on (kept together, in natural order)."""

# Membership levels carried by the membership feed.
MEMBERSHIP_LEVELS = ["Copper", "Silver", "Gold", "Diamond"]

# Inline product dimension joined to the order stream: (order_id, product_name).
PRODUCT_DIM_ROWS = [(4, "XBox"), (5, "PS5"), (0, "Saga"), (2, "Nintendo")]
PRODUCT_DIM_COLUMNS = ["order_id", "product_name"]

# Invoice date text as the sales feed writes it; parsing accepts it with or
# without zero padding (12/1/2010 8:26 and 12/01/2010 08:26 read the same).
INVOICE_DATE_FORMAT = "M/d/yyyy H:mm"

# A country name must contain at least one ASCII letter (unanchored).
COUNTRY_PATTERN = "[A-Za-z]"

# Stream delays and ranges of the pipelines.
SALES_WINDOW = "1 hour"
SALES_WATERMARK = "10 hours"
ORDER_WATERMARK = "2 hours"
MEMBER_WATERMARK = "3 hours"
MEMBER_WITHIN = "1 hour"
