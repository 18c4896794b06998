"""Reading and writing: review files, messages, models, lookups and result tables."""
