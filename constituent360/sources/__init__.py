"""Readers, writers and the adapters that shape warehouse tables into the domain model."""
