"""Registered check queries, their input bindings and their SQL oracles."""
