"""The jobs: plain functions any scheduler can call."""
