"""Where tables and streams come from and go to."""
