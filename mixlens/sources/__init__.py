"""Reading, staging and writing of reports and warehouse tables."""
