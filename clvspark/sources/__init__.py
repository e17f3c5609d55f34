"""Readers and writers of transactions, predictions and models."""
