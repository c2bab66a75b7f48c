"""DataFrame operators: cleaner, measures, insert-or-ignore, distributed ordering, quantiles."""
