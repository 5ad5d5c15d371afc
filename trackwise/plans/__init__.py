"""The jobs: per-trip basic features, per-trip kinematic features, per-vehicle roll-up."""
