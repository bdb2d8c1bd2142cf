"""Column-level functions: text, HTML, URLs, log lines."""
