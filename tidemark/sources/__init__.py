"""Readers: registry-described datasets, envelope zones and nested documents."""
