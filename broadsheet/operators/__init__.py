"""DataFrame operators: joins and filters, aggregates, windows, planning, writing, models."""
