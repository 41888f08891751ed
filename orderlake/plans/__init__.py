"""Layer runs, the query catalog and its SQL oracles."""
