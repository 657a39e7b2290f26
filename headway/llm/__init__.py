"""Operators for preparing large text corpora; nothing else imports them."""
