"""Views, reports, dashboard series and calendar measures over a star schema."""
