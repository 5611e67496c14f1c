"""The table-building jobs: Bronze, Silver, star schemas, Gold and what is read from them."""
