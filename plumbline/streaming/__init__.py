"""The reference works in batches only; here is the one hook a stream needs to run the same suites."""
