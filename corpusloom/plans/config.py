"""Configuration profiles of a library."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Config:
    data_root: str = "./data"
    backend: str = "hybrid"
    max_file_size: int = 100 << 20
    api_port: int = 8080
    clean_on_arrival: bool = True
    attribution_marker: str = "collected by the library"

    def problems(self) -> list[str]:
        """What is wrong; empty if nothing is."""
        said = []
        if not self.data_root:
            said.append("data root is required")
        if self.backend not in ("primary", "secondary", "hybrid"):
            said.append(f"unknown backend: {self.backend}")
        if self.max_file_size <= 0:
            said.append("max file size must be positive")
        if not 0 < self.api_port < 65536:
            said.append("port must be between 1 and 65535")
        return said


def default() -> Config:
    return Config()


def production() -> Config:
    return replace(default(), data_root="/var/lib/library")


def development() -> Config:
    return replace(default(), data_root="./dev-data", clean_on_arrival=False)
