"""DataFrame operators: counts, moments, shifts, validity, ranks, matching."""
