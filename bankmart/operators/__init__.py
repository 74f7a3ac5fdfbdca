"""DataFrame-to-DataFrame operators; no UDFs, no collects."""
