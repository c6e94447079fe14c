"""Sources and sinks: feeds, pages, page blocks, messages and tables."""
