"""DataFrame-to-DataFrame operators: sessions, load features, devices, statistics, models."""
