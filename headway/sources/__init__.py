"""Landed feed payloads and static archives."""
