"""Readers that deliver the eight raw ledger columns as text."""
