"""Reports (revenue, customers, logistics), the load pipeline (quality,
pipeline) and the extension analyses (insights). Every function takes and
returns DataFrames; nothing runs until an action."""
