"""DataFrame operators over host samples and process rows."""
