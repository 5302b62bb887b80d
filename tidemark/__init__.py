"""Timeline analytics over many recordings at once, as DataFrame-in, DataFrame-out operators."""
