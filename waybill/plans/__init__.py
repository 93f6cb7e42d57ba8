"""Refresh jobs and the registered queries."""
