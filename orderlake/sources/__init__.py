"""Sources and sinks: raw CSV reads, testdata mapping, table writes and reads."""
