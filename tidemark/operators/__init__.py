"""DataFrame -> DataFrame operators: bars, indicators, zipping, timelines."""
