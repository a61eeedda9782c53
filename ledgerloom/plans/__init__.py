"""Multi-step plans: run directories, the conversion run, registered queries."""
