"""Entity plans, load preparation and the dashboard, composed from the operators."""
