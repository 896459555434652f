"""DataFrame operators over profiles, weather, models and archives."""
