"""Small feed documents written by the tests."""

import json
from datetime import date, timedelta


def play(event_id, key="hit", period=1, time="5:00", kind="REG", situation="1551", **details):
    return {
        "eventId": event_id, "sortOrder": event_id * 10, "typeDescKey": key,
        "periodDescriptor": {"number": period, "periodType": kind}, "timeInPeriod": time,
        "timeRemaining": "15:00", "situationCode": situation, "details": details,
    }


def shift(game, player, team, start, end, period=1, number=1):
    return {"gameId": game, "playerId": player, "teamId": team, "period": period,
            "shiftNumber": number, "startTime": start, "endTime": end}


def play_by_play(game, plays, date="2024-10-08", season=20242025, kind=2, home=1, away=2):
    return {
        "id": game, "gameDate": date, "season": season, "gameType": kind,
        "homeTeam": {"id": home, "abbrev": f"T{home}"}, "awayTeam": {"id": away, "abbrev": f"T{away}"},
        "plays": plays,
    }


def game(game_id, date="2024-10-08", season=20242025, kind=2, home=1, away=2, state="OFF", **more):
    return {
        "id": game_id, "gameDate": date, "season": season, "gameType": kind,
        "venue": {"default": "Hall"}, "startTimeUTC": f"{date}T23:00:00Z",
        "easternUTCOffset": "-04:00", "venueUTCOffset": "-05:00", "gameState": state,
        "homeTeam": {"id": home, "abbrev": f"T{home}", "score": 2},
        "awayTeam": {"id": away, "abbrev": f"T{away}", "score": 1},
    } | more


def boxscore(game_id, home_players=(), away_players=(), goalies=(), date="2024-10-08"):
    return {
        "id": game_id, "gameDate": date, "homeTeam": {"id": 1}, "awayTeam": {"id": 2},
        "playerByGameStats": {
            "homeTeam": {"forwards": list(home_players), "defense": [], "goalies": list(goalies)},
            "awayTeam": {"forwards": list(away_players), "goalies": []},
        },
    }


class Landing:
    """Landing zone in a folder."""

    def __init__(self, root):
        self.root = root

    def put(self, feed, key, document, date=None):
        folder = self.root / feed / (f"feed_date={date}" if date else "")
        folder.mkdir(parents=True, exist_ok=True)
        text = document if isinstance(document, str) else json.dumps(document)
        (folder / f"{key}.json").write_text(text)

    def fill(self, start, end):
        """Empty score and standings documents for the days of a range that have none."""
        day, last = date.fromisoformat(start), date.fromisoformat(end)
        while day <= last:
            for feed in ("score", "standings"):
                if not (self.root / feed / f"feed_date={day}").exists():
                    self.put(feed, day, {"games": [], "standings": []}, str(day))
            day += timedelta(days=1)

    def put_game(self, game_id, date="2024-10-08", **replaced):
        """All documents of one sound game, some of them replaced."""
        documents = {
            "play_by_play": play_by_play(game_id, [
                play(1, "faceoff", time="0:00", winningPlayerId=11, losingPlayerId=21),
                play(2, "goal", time="0:30", eventOwnerTeamId=1, scoringPlayerId=11,
                     shootingPlayerId=11, homeScore=1, awayScore=0),
                play(3, "shot-on-goal", time="1:00", eventOwnerTeamId=2, shootingPlayerId=21),
            ], date=date),
            "shift_charts": {"data": [
                shift(game_id, 11, 1, "0:00", "1:00"), shift(game_id, 21, 2, "0:00", "1:30"),
            ]},
            "boxscore": boxscore(game_id, [{"playerId": 11, "goals": 1}], [{"playerId": 21}],
                                 date=date),
            "right_rail": {"gameInfo": {"referees": [{"default": "A"}, {"default": "B"}],
                                        "linesmen": [{"default": "C"}]}},
            "landing": game(game_id, date, gameOutcome={"lastPeriodType": "REG"}),
        } | replaced
        for feed, document in documents.items():
            if document is not None:
                self.put(feed, game_id, document, date)
