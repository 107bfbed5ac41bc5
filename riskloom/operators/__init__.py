"""DataFrame -> DataFrame transforms; every one is lazy and stays inside Catalyst."""
