"""DataFrame-to-DataFrame operators the daily build is composed of."""
