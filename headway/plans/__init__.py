"""The jobs a user runs: bronze, silver and gold loads."""
